"""Most frequent value per user."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, Columns


def favorites(
    df: DataFrame,
    wanted: Mapping[str, str],
    cols: Columns = DEFAULT,
    distinct: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per user with the favourite of each column in ``wanted`` (output name -> column).

    The favourite has the highest count, then the lowest value; null is a value that loses ties.
    ``distinct`` names outputs that count the different non-null values of a wanted column.

    All columns are counted in one pass with grouping sets, combined before the shuffle, so one
    user's rows never meet in a single task; a second, small aggregation picks the winners.
    """
    sources = sorted(set(wanted.values()))
    sets = [[cols.user, source] for source in sources]
    every = (1 << len(sources)) - 1
    counts = df.groupingSets(sets, cols.user, *sources).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n")
    )

    def in_set(source: str):
        # A bit is set for each column left out of the grouping set.
        return F.col("_set") == every - (1 << (len(sources) - 1 - sources.index(source)))

    outputs = []
    for name, source in wanted.items():
        ranked = F.struct((-F.col("_n")).alias("n"), F.col(source).isNull().alias("gap"), F.col(source))
        outputs.append(F.min(F.when(in_set(source), ranked))[source].alias(name))
    for name, source in (distinct or {}).items():
        outputs.append(F.count_if(in_set(source) & F.col(source).isNotNull()).alias(name))
    return counts.groupBy(cols.user).agg(*outputs)


def favorite(df: DataFrame, source: str, name: str, cols: Columns = DEFAULT) -> DataFrame:
    """One row per user with the most frequent value of ``source``."""
    return favorites(df, {name: source}, cols)
