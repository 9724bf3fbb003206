"""Feature statistics and dataset profiles as tidy tables, one pass per kind of column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trolley.columns import DEFAULT, Columns
from trolley.functions.quantiles import exact_percentiles
from trolley.functions.scratch import materialize

# Percentiles of a numeric feature and the number of most frequent values kept.
PERCENTILES = (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)
TOP_VALUES = 10

_NUMERIC = (
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.DecimalType,
    T.ShortType,
)


def numeric_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def categorical_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def embedding_features(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]


def numeric_statistics(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per numeric column: count, nulls, range, mean, sample deviation, exact percentiles.

    The columns are written once to the shared folder, as the percentiles take a few scans.
    """
    names = list(columns or numeric_features(df))
    types = dict(df.dtypes)
    stored = materialize(df.select(*names), "numeric-features")
    cuts = exact_percentiles(stored, names, PERCENTILES)

    def summary(c: str) -> Column:
        value = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("feature"),
            F.lit(types[c]).alias("dtype"),
            F.count(c).alias("count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            *[F.lit(x).cast("double").alias(f"p{round(p * 100):02d}") for p, x in zip(PERCENTILES, cuts[c])],
        )

    return stored.agg(F.array(*[summary(c) for c in names]).alias("rows")).select(F.inline("rows"))


def value_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(feature, value, count)`` of several columns, values as text, null kept as a value."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def unique_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Distinct values per column; null counts as a value."""
    counts = value_counts(df, columns or categorical_features(df))
    return counts.groupBy("feature").agg(F.count(F.lit(1)).alias("unique_count"))


def top_values(
    df: DataFrame, columns: Iterable[str] | None = None, k: int = TOP_VALUES
) -> DataFrame:
    """The ``k`` most frequent values per column: count descending, then value, null first."""
    counts = value_counts(df, columns or categorical_features(df))
    order = Window.partitionBy("feature").orderBy(F.desc("count"), F.asc_nulls_first("value"))
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def categorical_statistics(
    df: DataFrame, columns: Iterable[str] | None = None, k: int = TOP_VALUES
) -> DataFrame:
    """One row per column and frequent value: rank, count and the column's distinct values."""
    names = list(columns or categorical_features(df))
    return top_values(df, names, k).join(unique_counts(df, names), "feature")


def embedding_statistics(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per vector column: rows, nulls, mean length of the vectors present."""
    names = list(columns or embedding_features(df))
    types = dict(df.dtypes)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(types[c]).alias("dtype"),
            F.count(F.lit(1)).alias("count"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.avg(F.when(F.col(c).isNotNull(), F.size(c))).alias("avg_dimension"),
        )
        for c in names
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def embedding_coverage(items: DataFrame) -> DataFrame:
    return items.agg(F.avg("embedding_available").alias("coverage_ratio"))


def feature_statistics(df: DataFrame, dataset_name: str) -> DataFrame:
    """All statistics of a table as ``(dataset, kind, feature, stat, value)`` text rows."""

    def tidy(stats: DataFrame, kind: str) -> DataFrame:
        names = [c for c in stats.columns if c != "feature"]
        pairs = F.array(
            *[F.struct(F.lit(c).alias("stat"), F.col(c).cast("string").alias("value")) for c in names]
        )
        return stats.select(F.lit(kind).alias("kind"), "feature", F.inline(pairs))

    shape = df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(dataset_name).alias("feature"), "row_count", F.lit(len(df.columns)).alias("column_count")
    )
    parts = [tidy(shape, "table")]
    if numeric_features(df):
        parts.append(tidy(numeric_statistics(df), "numeric"))
    if categorical_features(df):
        parts.append(tidy(unique_counts(df), "categorical"))
        listed = top_values(df).select(
            F.lit("top_value").alias("kind"),
            "feature",
            F.coalesce("value", F.lit("None")).alias("stat"),
            F.col("count").cast("string").alias("value"),
        )
        parts.append(listed)
    if embedding_features(df):
        parts.append(tidy(embedding_statistics(df), "embedding"))
    if "embedding_available" in df.columns:
        parts.append(
            tidy(
                embedding_coverage(df).select(
                    F.lit("embedding_available").alias("feature"), "coverage_ratio"
                ),
                "coverage",
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result.select(F.lit(dataset_name).alias("dataset"), "kind", "feature", "stat", "value")


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and share per column."""
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count_if(F.col(c).isNull()).alias("null_count"),
            F.avg(F.col(c).isNull().cast("int")).alias("null_share"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def column_cardinality(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Distinct values of every column except ``skip``; null counts as a value."""
    left_out = set(skip)
    return unique_counts(df, [c for c in df.columns if c not in left_out])


def dataset_profile(df: DataFrame, dataset_name: str, cols: Columns = DEFAULT) -> DataFrame:
    """One row: shape, distinct users and items, time range, vector length; null where absent."""

    def when_present(column: str, value: Column, kind: str) -> Column:
        return value if column in df.columns else F.lit(None).cast(kind)

    return df.agg(
        F.lit(dataset_name).alias("dataset_name"),
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        when_present(cols.user, F.count_distinct(F.col(cols.user)), "bigint").alias("unique_customers"),
        when_present(cols.item, F.count_distinct(F.col(cols.item)), "bigint").alias("unique_articles"),
        when_present(cols.time, F.min(F.col(cols.time)), "timestamp_ntz").alias("min_timestamp"),
        when_present(cols.time, F.max(F.col(cols.time)), "timestamp_ntz").alias("max_timestamp"),
        when_present(cols.vector, F.max(F.size(F.col(cols.vector))), "int").alias(
            "embedding_dimension"
        ),
    )
