"""Statistics of a growing dataset from one small state per chunk and column.

A chunk's state can be merged with others: counts, range, mean and squared deviations are exact (up to
rounding), quantiles come from a KLL sketch and distinct counts from a HyperLogLog sketch. A new chunk adds its own
states; the statistics of everything so far are merged from the states, and no old chunk is read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from trolley.operators.profile import PERCENTILES, categorical_features, numeric_features
from trolley.streaming.chunks import FILES_PER_CHUNK, process_chunks, read_chunks

#: Size parameters of the sketches, and the errors their statistics keep: of a rank, and of a distinct count.
QUANTILE_SIZE, DISTINCT_BITS = 1000, 14
RANK_ERROR, DISTINCT_ERROR = 0.01, 0.04


def chunk_states(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per number or text column, from one aggregation of ``df``.

    ``feature, rows, count, low, high, mean, squares, quantiles, values``; text has counts and ``values`` only.
    Not-a-number takes no part in quantiles.
    """
    numbers = numeric_features(df)
    names = list(columns or [*numbers, *categorical_features(df)])

    def state(name: str) -> Column:
        column = F.col(f"`{name}`")
        value = column.cast("double") if name in numbers else F.lit(None).cast("double")
        return F.struct(
            F.lit(name).alias("feature"),
            F.count(F.lit(1)).alias("rows"),
            F.count(column).alias("count"),
            F.min(value).alias("low"),
            F.max(value).alias("high"),
            F.avg(value).alias("mean"),
            (F.var_pop(value) * F.count(value)).alias("squares"),
            F.kll_sketch_agg_double(value, F.lit(QUANTILE_SIZE)).alias("quantiles"),
            # Values of any type are counted by their hashes.
            F.hll_sketch_agg(F.when(column.isNotNull(), F.xxhash64(column)), F.lit(DISTINCT_BITS)).alias("values"),
        )

    return df.agg(F.array(*[state(c) for c in names]).alias("states")).select(F.inline("states"))


def merged_statistics(states: DataFrame) -> DataFrame:
    """Counts, range, mean, sample deviation, percentiles and distinct values of each feature.

    A feature has as many states as there are chunks, and its states are merged pair by pair.
    """
    inside = Window.partitionBy("feature")
    total = F.sum(F.col("mean") * F.col("count")).over(inside) / F.sum("count").over(inside)
    shift = F.col("mean") - F.col("whole_mean")
    spread = F.coalesce(F.col("squares") + F.col("count") * shift * shift, F.lit(0.0))
    found = (
        states.withColumn("whole_mean", F.when(F.sum("count").over(inside) > 0, total))
        .groupBy("feature")
        .agg(
            F.sum("count").alias("count"),
            (F.sum("rows") - F.sum("count")).alias("null_count"),
            F.min("low").alias("min"),
            F.max("high").alias("max"),
            F.first("whole_mean").alias("mean"),
            F.sum(spread).alias("squares"),
            F.kll_merge_agg_double("quantiles").alias("quantiles"),
            F.hll_sketch_estimate(F.hll_union_agg("values")).alias("unique_count"),
        )
    )
    measured = F.col("max").isNotNull()
    cuts = [
        F.when(measured, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(f"p{round(p * 100):02d}")
        for p in PERCENTILES
    ]
    deviation = F.when(measured & (F.col("count") > 1), F.sqrt(F.col("squares") / (F.col("count") - 1)))
    return found.select("feature", "count", "null_count", "min", "max", "mean", deviation.alias("std"), *cuts, "unique_count")


def update_states(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    output: str,
    checkpoint: str,
    files_per_chunk: int = FILES_PER_CHUNK,
) -> DataFrame:
    """Add the states of all new files below ``path`` and return all states."""
    process_chunks(spark, path, schema, chunk_states, output, checkpoint, files_per_chunk)
    return read_chunks(spark, output).drop("chunk")
