"""Scaling by statistics of the whole table, read once as a scalar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.functions.vectors import finite_or_zero


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
        ).alias("s")
    ).scalar()

    def scaled(c: str):
        std = F.col(f"_stats.std_{c}")
        return (F.col(c) - F.col(f"_stats.mean_{c}")) / F.when(std == 0, 1.0).otherwise(std)

    measured = df.withColumn("_stats", stats)
    return measured.withColumns({c: scaled(c) for c in columns}).drop("_stats")


def scale_vectors(df: DataFrame, column: str) -> DataFrame:
    """Standard scaling of every vector position.

    Statistics are grouped by position, so their size is the vector length, not the rows.
    """
    values = df.select(F.posexplode(column).alias("position", "value"))
    per_position = values.groupBy("position").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )
    stats = per_position.agg(
        F.array_sort(F.collect_list(F.struct("position", "mean", "std"))).alias("s")
    ).scalar()
    zipped = F.zip_with(
        F.col(column).cast("array<double>"),
        F.col("_stats"),
        lambda x, s: (x - s["mean"]) / F.when(s["std"] == 0, 1.0).otherwise(s["std"]),
    )
    return df.withColumn("_stats", stats).withColumn(column, zipped).drop("_stats")


def finite_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null, NaN and infinite values of the columns become 0."""
    return df.withColumns({c: finite_or_zero(c) for c in columns})
