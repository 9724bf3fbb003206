"""Feature tables to training sets and their dimension tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from trolley.columns import DEFAULT, TRAINING_ITEM_NUMERICS, Columns
from trolley.operators.encoding import (
    align_items,
    encode_item_matrix,
    encode_user_matrix,
    item_index,
    user_index,
    vocabulary,
)
from trolley.operators.items import dedup_embeddings
from trolley.operators.split import TRAIN
from trolley.operators.training import (
    NEGATIVE_RATIO,
    SEED,
    in_shuffle_order,
    ranking_chunk,
    ranking_dataset,
    retrieval_dataset,
    two_tower_chunk,
    two_tower_dataset,
    write_ranking_lookups,
    write_two_tower_lookups,
)
from trolley.sources.sinks import write_ordered, write_table
from trolley.sources.tables import Catalog
from trolley.streaming.chunks import FILES_PER_CHUNK, process_chunks

# Rows per written training file.
ROWS_PER_FILE = 1_000_000


def lookup_job(
    spark: SparkSession, source: Catalog, features: Catalog, output: str, cols: Columns = DEFAULT
) -> None:
    """Dimension tables that replace in-memory lookups: ids, vocabularies, matrices, vectors."""
    users = features.load(spark, "user_features", cols=cols)
    items = features.load(spark, "item_features", cols=cols)
    embeddings = source.load(spark, "embeddings", cols=cols)
    aligned = align_items(items, embeddings, cols)
    tables = {
        "user_index": user_index(users, cols),
        "item_index": item_index(aligned, cols),
        "vocab_category": vocabulary(users, "favorite_category"),
        "vocab_color": vocabulary(users, "favorite_color"),
        "user_matrix": encode_user_matrix(users, cols=cols),
        "item_matrix": encode_item_matrix(aligned, cols=cols),
        "item_lookup": aligned.select(cols.item, *TRAINING_ITEM_NUMERICS),
        "item_vectors": dedup_embeddings(embeddings, cols),
    }
    for name, table in tables.items():
        write_table(table, f"{output}/lookups/{name}")


def ranking_set_job(
    spark: SparkSession,
    source: Catalog,
    features: Catalog,
    output: str,
    ratio: int = NEGATIVE_RATIO,
    seed: int = SEED,
    rows_per_file: int = ROWS_PER_FILE,
    cols: Columns = DEFAULT,
) -> None:
    """Positives and seeded negatives, written in shuffled order."""
    rows = ranking_dataset(
        features.load(spark, "two_tower_interactions", TRAIN, cols=cols),
        features.load(spark, "item_features", cols=cols),
        source.load(spark, "embeddings", cols=cols),
        ratio,
        seed,
        cols,
    )
    write_ordered(in_shuffle_order(rows), f"{output}/ranking", rows_per_file)


def two_tower_set_job(
    spark: SparkSession,
    source: Catalog,
    features: Catalog,
    output: str,
    rows_per_file: int = ROWS_PER_FILE,
    cols: Columns = DEFAULT,
) -> None:
    """Purchases with dense ids and vector, and the typed retrieval inputs."""
    train = features.load(spark, "two_tower_interactions", TRAIN, cols=cols)
    embeddings = source.load(spark, "embeddings", cols=cols)
    users = spark.read.parquet(f"{output}/lookups/user_index")
    items = spark.read.parquet(f"{output}/lookups/item_index")
    prepared = two_tower_dataset(train, users, items, embeddings, cols)
    write_table(prepared, f"{output}/two_tower", rows_per_file=rows_per_file)
    typed = retrieval_dataset(train, embeddings, cols=cols)
    write_table(typed, f"{output}/retrieval", rows_per_file=rows_per_file)


def two_tower_chunks_job(
    spark: SparkSession,
    source: Catalog,
    features: Catalog,
    output: str,
    checkpoint: str,
    files_per_chunk: int = FILES_PER_CHUNK,
    cols: Columns = DEFAULT,
) -> None:
    """The two-tower set built chunk by chunk as new interaction files arrive."""
    path = f"{features.path('two_tower_interactions')}/split={TRAIN}"
    schema = spark.read.parquet(path).schema
    embeddings = source.load(spark, "embeddings", cols=cols)
    users = spark.read.parquet(f"{output}/lookups/user_index")
    items = spark.read.parquet(f"{output}/lookups/item_index")
    lookups = write_two_tower_lookups(users, items, embeddings, f"{output}/buckets/two_tower", cols)
    process_chunks(
        spark,
        path,
        schema,
        lambda chunk: two_tower_chunk(chunk, lookups, cols),
        f"{output}/two_tower_chunks",
        checkpoint,
        files_per_chunk,
    )


def ranking_chunks_job(
    spark: SparkSession,
    source: Catalog,
    features: Catalog,
    output: str,
    checkpoint: str,
    ratio: int = NEGATIVE_RATIO,
    seed: int = SEED,
    files_per_chunk: int = FILES_PER_CHUNK,
    cols: Columns = DEFAULT,
) -> None:
    """The ranking set built chunk by chunk; purchases known when it starts are never drawn."""
    path = f"{features.path('two_tower_interactions')}/split={TRAIN}"
    log = spark.read.parquet(path)
    items = features.load(spark, "item_features", cols=cols)
    embeddings = source.load(spark, "embeddings", cols=cols)
    lookups = write_ranking_lookups(log, items, embeddings, f"{output}/buckets/ranking", cols)
    process_chunks(
        spark,
        path,
        log.schema,
        lambda chunk: ranking_chunk(chunk, lookups, ratio, seed, cols),
        f"{output}/ranking_chunks",
        checkpoint,
        files_per_chunk,
    )
