"""Wide tables to splits, feature tables and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trolley.columns import DEFAULT, Columns
from trolley.operators.items import item_features
from trolley.operators.profile import feature_statistics
from trolley.operators.ranking import ranking_features
from trolley.operators.split import TRAIN, Ratios, split_metadata, temporal_split
from trolley.operators.users import user_features
from trolley.sources.sinks import schema_rows, write_artifact, write_table
from trolley.sources.tables import Catalog

# Job names in the order they depend on each other.
JOBS = ("split", "user", "item", "ranking")


def _store(spark: SparkSession, df: DataFrame, catalog: Catalog, name: str) -> None:
    """Write a feature table, then describe the stored copy."""
    path = catalog.path(name)
    write_table(df, path)
    stored = spark.read.parquet(path)
    write_artifact(feature_statistics(stored, name), f"{catalog.root}/artifacts/{name}_statistics")
    write_artifact(schema_rows(stored, name), f"{catalog.root}/artifacts/{name}_schema")


def split_job(
    spark: SparkSession,
    source: Catalog,
    target: Catalog,
    ratios: Ratios = Ratios(),
    environment: str = "prod",
    embedding_dimension: int = 512,
    cols: Columns = DEFAULT,
) -> None:
    """Both wide tables, partitioned by ``split``, and the row counts of the ranking split."""
    for name in ("ranking_interactions", "two_tower_interactions"):
        parts = temporal_split(source.load(spark, name, cols=cols), ratios, cols)
        write_table(parts, target.path(name), partition_by=["split"])
    stored = spark.read.parquet(target.path("ranking_interactions"))
    metadata = split_metadata(stored, environment, embedding_dimension)
    write_artifact(metadata, f"{target.root}/artifacts/split_metadata")


def user_job(spark: SparkSession, target: Catalog, cols: Columns = DEFAULT) -> None:
    train = target.load(spark, "two_tower_interactions", TRAIN, cols=cols)
    _store(spark, user_features(train, cols), target, "user_features")


def item_job(
    spark: SparkSession, source: Catalog, target: Catalog, cols: Columns = DEFAULT
) -> None:
    train = target.load(spark, "two_tower_interactions", TRAIN, cols=cols)
    embeddings = source.load(spark, "embeddings", cols=cols)
    _store(spark, item_features(train, embeddings, cols), target, "item_features")


def ranking_job(spark: SparkSession, target: Catalog, cols: Columns = DEFAULT) -> None:
    train = target.load(spark, "ranking_interactions", TRAIN, cols=cols)
    users = target.load(spark, "user_features", cols=cols)
    items = target.load(spark, "item_features", cols=cols)
    _store(spark, ranking_features(train, users, items, cols), target, "ranking_features")


def run_feature_jobs(
    spark: SparkSession,
    source: Catalog,
    target: Catalog,
    job: str = "all",
    ratios: Ratios = Ratios(),
    environment: str = "prod",
    cols: Columns = DEFAULT,
) -> None:
    """One job, or all in order. Jobs hand over through stored tables only."""
    if job not in (*JOBS, "all"):
        raise ValueError(f"job is one of {', '.join(JOBS)} or all")
    if job in ("split", "all"):
        split_job(spark, source, target, ratios, environment, cols=cols)
    if job in ("user", "all"):
        user_job(spark, target, cols)
    if job in ("item", "all"):
        item_job(spark, source, target, cols)
    if job in ("ranking", "all"):
        ranking_job(spark, target, cols)
