"""Raw tables to the two wide interaction tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from trolley.columns import DEFAULT, Columns
from trolley.operators.clean import preprocess
from trolley.operators.interactions import ranking_interactions, two_tower_interactions
from trolley.sources.sinks import write_table
from trolley.sources.tables import Catalog, read_all_raw

# Which tables a run builds.
MODES = ("ranking", "two_tower", "both")


def run_etl(
    spark: SparkSession, raw: str, output: str, mode: str = "both", cols: Columns = DEFAULT
) -> None:
    """Clean the raw tables once, store them, and build the wide tables from the stored copy."""
    if mode not in MODES:
        raise ValueError(f"mode is one of {', '.join(MODES)}")
    articles, customers, transactions = read_all_raw(spark, raw)
    cleaned = preprocess(customers, articles, transactions, cols)
    stored = {}
    for name, table in zip(("customers", "articles", "transactions"), cleaned):
        path = f"{output}/clean/{name}"
        write_table(table, path)
        stored[name] = spark.read.parquet(path)
    tables = (stored["transactions"], stored["customers"], stored["articles"])
    catalog = Catalog(output)
    if mode in ("ranking", "both"):
        write_table(ranking_interactions(*tables, cols=cols), catalog.path("ranking_interactions"))
    if mode in ("two_tower", "both"):
        write_table(two_tower_interactions(*tables, cols=cols), catalog.path("two_tower_interactions"))
