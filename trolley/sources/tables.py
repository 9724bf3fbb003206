"""Reading the tables of the interaction model."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trolley.columns import ARTICLES, CUSTOMERS, DEFAULT, TRANSACTIONS, Columns
from trolley.operators.clean import normalize_ids

# Names of the three raw tables below the base path.
RAW_TABLES: Mapping[str, T.StructType] = {
    "articles": ARTICLES,
    "customers": CUSTOMERS,
    "transactions": TRANSACTIONS,
}

# Relative paths of the processed datasets.
DATASETS: Mapping[str, str] = {
    "ranking_interactions": "ranking_interactions",
    "two_tower_interactions": "two_tower_interactions",
    "user_features": "user_features",
    "item_features": "item_features",
    "ranking_features": "ranking_features",
    "embeddings": "embeddings",
}


def read_raw(
    spark: SparkSession, base: str, name: str, schema: T.StructType | None = None
) -> DataFrame:
    """One raw parquet table; without ``schema`` the file's own types are kept.

    With it the columns come in its order and types: a number may be read as text or as a wider number, a
    missing column is null, and a type that would lose values is an error.
    """
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df if schema is None else df.to(schema)


def read_all_raw(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Articles, customers, transactions with their declared types. Lazy: nothing is counted."""
    return tuple(read_raw(spark, base, name, schema) for name, schema in RAW_TABLES.items())


def read_normalized(spark: SparkSession, path: str, cols: Columns = DEFAULT) -> DataFrame:
    """A parquet dataset with item ids padded and user ids as text."""
    return normalize_ids(spark.read.parquet(path), cols)


def read_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A file or partitioned folder; only the named columns reach the scan."""
    df = spark.read.parquet(path)
    return df if columns is None else df.select(*columns)


@dataclass(frozen=True)
class Catalog:
    """Named datasets below one root; ``paths`` overrides single locations."""

    root: str
    paths: Mapping[str, str] = field(default_factory=dict)

    def path(self, name: str) -> str:
        if name in self.paths:
            return self.paths[name]
        if name not in DATASETS:
            raise KeyError(f"unknown dataset {name}; known: {', '.join(DATASETS)}")
        return f"{self.root.rstrip('/')}/{DATASETS[name]}"

    def load(
        self,
        spark: SparkSession,
        name: str,
        split: str | None = None,
        columns: Sequence[str] | None = None,
        cols: Columns = DEFAULT,
    ) -> DataFrame:
        """A dataset by name, optionally one split (partition-pruned) and some columns."""
        df = spark.read.parquet(self.path(name))
        if split is not None:
            df = df.where(F.col("split") == split).drop("split")
        df = normalize_ids(df, cols)
        return df if columns is None else df.select(*columns)
