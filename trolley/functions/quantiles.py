"""Exact order statistics of many columns with bounded state per task.

Numbers are found by histograms that are refined over a few scans. At first a bin is the sign and magnitude of a
value, which keeps the order: eighths of a power of two, small whole numbers as they are. Then each bin that holds
a wanted rank is cut to ``BINS`` parts of equal width between its least and largest value, until it holds one value
only. All columns and all ranks are refined in the same scan. Tasks add up counts, so no value is shuffled, and
a double takes at most six scans, two or three as a rule.

Other types are counted per value, and the counts put in order by ranges.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.functions.ordered import running_totals

#: Parts of a bin in each refinement: with the columns and ranks it bounds what a scan returns.
BINS = 4096
# Types whose values are counted as whole and as real numbers; others keep their type.
WHOLE = ("tinyint", "smallint", "int", "bigint")
REAL = ("float", "double")
#: Whole numbers below this are bins of their own; parts of a power of two that are bins for larger and real ones.
SMALL, PARTS = 2048, 8
#: Places of the first bins: magnitudes (shifted to be positive), infinity, not a number.
SHIFT, INFINITE, NO_NUMBER = 1100 * PARTS, 30_000, 40_000


@dataclass
class _Slot:
    """A range of a column's values that holds wanted ranks; ``before`` rows are below it."""

    column: str
    before: int
    ranks: dict[int, int]  # place of the share: rank, None until the rows are counted
    low: Any = None
    high: Any = None


def _kind(type_name: str) -> str | None:
    """The type a column's values are compared in; None if it is no number."""
    if type_name in WHOLE:
        return "bigint"
    if type_name in REAL:
        return "double"
    return type_name if type_name.startswith("decimal") else None


def _magnitude(value: Column, kind: str) -> Column:
    """Bins by sign and magnitude: larger numbers never have a smaller bin."""
    number = value.cast("double")
    size = F.abs(number)
    power = F.floor(F.log2(size) * PARTS).cast("int") + SHIFT
    if kind == "bigint":
        return F.when(size < SMALL, value.cast("int")).otherwise(F.signum(number).cast("int") * power)
    place = F.when(size == 0, 0).when(size == float("inf"), INFINITE).otherwise(power)
    return F.when(F.isnan(number), NO_NUMBER).otherwise(F.when(number < 0, -place).otherwise(place))


def _entries(slots: dict[int, _Slot], kinds: dict[str, str]) -> list[Column]:
    """For each column a struct of slot, bin and value; the slot is null outside all ranges."""
    fields = sorted(set(kinds.values()))
    by_column: dict[str, list[int]] = defaultdict(list)
    for number, slot in slots.items():
        by_column[slot.column].append(number)
    entries = []
    for column, numbers in by_column.items():
        kind = kinds[column]
        value = F.col(f"`{column}`").cast(kind)
        slot, place = F.lit(None).cast("int"), F.lit(None).cast("int")
        for n in numbers:
            low, high = slots[n].low, slots[n].high
            if low is None:
                slot, place = F.when(value.isNotNull(), n), _magnitude(value, kind)
                continue
            least, most = F.lit(low).cast(kind), F.lit(high).cast(kind)
            inside = value.between(least, most)
            share = (value - least).cast("double") / (most - least).cast("double")
            part = F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1))
            slot, place = F.when(inside, n).otherwise(slot), F.when(inside, part).otherwise(place)
        values = [(value if f == kind else F.lit(None).cast(f)).alias(f"v{i}") for i, f in enumerate(fields)]
        entries.append(F.struct(slot.alias("slot"), place.alias("bin"), *values))
    return entries


def _scan(df: DataFrame, slots: dict[int, _Slot], kinds: dict[str, str]) -> dict[int, list[tuple]]:
    """Of each slot its bins in order: rows, least and largest value, and whether they are one."""
    fields = sorted(set(kinds.values()))
    rows = df.select(F.inline(F.array(*_entries(slots, kinds)))).where(F.col("slot").isNotNull())
    ends = [x for i in range(len(fields)) for x in (F.min(f"v{i}").alias(f"low{i}"), F.max(f"v{i}").alias(f"high{i}"))]
    counted = rows.groupBy("slot", "bin").agg(F.count(F.lit(1)).alias("n"), *ends)
    single = [F.col(f"low{i}").eqNullSafe(F.col(f"high{i}")).alias(f"one{i}") for i in range(len(fields))]
    bins: dict[int, list[tuple]] = defaultdict(list)
    for row in counted.select("*", *single).orderBy("slot", "bin").collect():  # BINS for each slot at most
        i = fields.index(kinds[slots[row["slot"]].column])
        bins[row["slot"]].append((row["n"], row[f"low{i}"], row[f"high{i}"], row[f"one{i}"]))
    return bins


def exact_percentiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list]:
    """For each number column the values at the shares: the smallest one whose share of rows reaches it.

    ``df`` is read once for each refinement: pass a stored table. Nulls do not count; an all-null column gives
    None. Not-a-number is the largest value. Whole numbers and decimals keep their type.
    """
    types = dict(df.dtypes)
    kinds = {c: _kind(types[c]) for c in columns}
    odd = [c for c, kind in kinds.items() if kind is None]
    if odd:
        raise ValueError(f"no numbers: {odd}")
    found: dict[str, list] = {c: [None] * len(shares) for c in columns}
    exact = [Fraction(str(s)) for s in shares]
    slots = {i: _Slot(c, 0, dict.fromkeys(range(len(shares)), 0)) for i, c in enumerate(columns)}
    first = True
    while slots:
        after: dict[int, _Slot] = {}
        for number, bins in _scan(df, slots, kinds).items():
            slot, before = slots[number], slots[number].before
            if first:
                rows = sum(n for n, *_ in bins)
                slot.ranks = {k: max(1, math.ceil(rows * share)) for k, share in enumerate(exact)}
            for n, low, high, single in bins:
                ranks = {k: r for k, r in slot.ranks.items() if before < r <= before + n}
                if ranks and single:
                    for k in ranks:
                        found[slot.column][k] = low
                elif ranks:
                    after[len(after)] = _Slot(slot.column, before, ranks, low, high)
                before += n
        slots, first = after, False
    return found


def exact_quantiles(df: DataFrame, columns: Sequence[str], p: float = 0.5) -> dict[str, Any]:
    """The smallest value of each column whose share of rows at or below it reaches ``p``.

    Columns of any type that has an order; values keep their type. All-null columns give None.
    """
    types = dict(df.dtypes)
    numbers = [c for c in columns if _kind(types[c])]
    found: dict[str, Any] = dict.fromkeys(columns)
    if numbers:
        found |= {c: values[0] for c, values in exact_percentiles(df, numbers, [p]).items()}
    return found | _by_counting(df, [c for c in columns if c not in numbers], p)


def _by_counting(df: DataFrame, columns: Sequence[str], p: float) -> dict[str, Any]:
    """Columns of a type are counted per value in one pass, the counts are range-partitioned in value order
    with running totals, and the row that reaches the rank is picked."""
    groups: dict[str, list[str]] = defaultdict(list)
    types = dict(df.dtypes)
    for column in columns:
        groups[types[column]].append(column)
    found: dict[str, Any] = {}
    for names in groups.values():
        entries = [F.struct(F.lit(i).alias("number"), F.col(c).alias("value")) for i, c in enumerate(names)]
        values = df.select(F.inline(F.array(*entries))).where(F.col("value").isNotNull())
        counts = values.groupBy(F.struct("number", "value").alias("place")).agg(F.count(F.lit(1)).alias("n"))
        placed = running_totals(counts, "place", ["n"], "quantiles")
        sizes = placed.groupBy("place.number").agg(F.sum("n").alias("rows"), F.min("n_before").alias("before"))
        reached = F.lit(False)
        for row in sizes.collect():
            rank = row["before"] + max(1, math.ceil(row["rows"] * Fraction(str(p))))
            here = F.col("place.number") == row["number"]
            reached = reached | (here & (F.col("n_before") < rank) & (F.col("n_before") + F.col("n") >= rank))
        for row in placed.where(reached).select("place.number", "place.value").collect():
            found[names[row["number"]]] = row["value"]
    return found
