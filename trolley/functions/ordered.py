"""Global order without a global window.

Rows are range-partitioned, written once, and numbered inside each partition; the
partition totals (one row per partition) give the offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.functions.scratch import materialize

# Layout of monotonically_increasing_id, partition number above 33 bits of position.
POSITION_BITS = 33


def _offsets(sizes: DataFrame, part: str, totals: list[str]) -> DataFrame:
    """Exclusive running totals over the partitions. One row per partition, so small by design."""
    before = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        part, *[F.coalesce(F.sum(t).over(before), F.lit(0)).alias(f"_before_{t}") for t in totals]
    )


def dense_index(df: DataFrame, key: str, index: str, start: int = 0) -> DataFrame:
    """Distinct non-null ``key`` values, numbered without gaps in key order."""
    ordered = (
        df.select(key)
        .where(F.col(key).isNotNull())
        .distinct()
        .repartitionByRange(key)
        .sortWithinPartitions(key)
        .select(key, F.monotonically_increasing_id().alias("_place"))
    )
    stored = materialize(ordered, f"index-{index}").select(
        key,
        F.shiftright("_place", POSITION_BITS).alias("_part"),
        F.col("_place").bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).alias("_position"),
    )
    sizes = stored.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    offsets = _offsets(sizes, "_part", ["_rows"])
    return stored.join(F.broadcast(offsets), "_part").select(
        key, (F.lit(start) + F.col("_before__rows") + F.col("_position")).cast("bigint").alias(index)
    )


def running_totals(df: DataFrame, order: str, totals: list[str], name: str) -> DataFrame:
    """Add ``<total>_before``: the sum of ``total`` over all rows with a smaller ``order`` value.

    ``order`` must be unique (aggregate first), so ranges cut into even partitions.
    """
    placed = materialize(
        df.repartitionByRange(order).withColumn("_part", F.spark_partition_id()), name
    )
    sizes = placed.groupBy("_part").agg(*[F.sum(t).alias(t) for t in totals])
    offsets = _offsets(sizes, "_part", totals)
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def before(total: str) -> Column:
        local = F.coalesce(F.sum(total).over(inside), F.lit(0))
        return (F.col(f"_before_{total}") + local).alias(f"{total}_before")

    joined = placed.join(F.broadcast(offsets), "_part")
    return joined.select(*df.columns, *[before(t) for t in totals])
