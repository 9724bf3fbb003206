"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, Columns
from trolley.functions.scratch import materialize


def skew_join(
    facts: DataFrame,
    table: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    null_keys: bool = False,
    computed: bool = False,
) -> DataFrame:
    """Join ``facts`` to a keyed ``table`` (one row per key); ``how`` is left or inner.

    One plan for every size: Spark broadcasts the table if its measured size allows it, else it
    cuts the shuffled partition of a hot key (null keys of a left join too) to parts of the
    advisory size and joins each with the key's row. That needs adaptive execution with
    its skew join, which are on by default, and both sides fresh from a shuffle: a table ``computed``
    by its key (an aggregate, a join) would be used as it lies, so it is written to the shared folder first.
    ``null_keys`` lets null keys match null keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if computed:
        table = materialize(table, "keyed-side")
    if not null_keys:
        return facts.join(table, keys, how)
    right = table.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda x, y: x & y, [facts[k].eqNullSafe(right[f"_{k}"]) for k in keys])
    return facts.join(right, same, how).drop(*[f"_{k}" for k in keys])


def star_join(
    transactions: DataFrame, customers: DataFrame, articles: DataFrame, cols: Columns = DEFAULT
) -> DataFrame:
    """Every transaction with its customer and article attributes; no attribute may occur twice."""
    require_distinct_columns(transactions, customers.drop(cols.user), articles.drop(cols.item))
    named = skew_join(transactions, customers, cols.user)
    return skew_join(named, articles, cols.item)


def duplicate_columns(*tables: DataFrame) -> list[str]:
    """Names that occur more than once in tables to be put side by side, without regard to case as in Spark."""
    names = [c.lower() for df in tables for c in df.columns]
    return sorted({c for c in names if names.count(c) > 1})


def require_distinct_columns(*tables: DataFrame) -> None:
    """Stop before a join whose result would have two columns of one name."""
    found = duplicate_columns(*tables)
    if found:
        raise ValueError(f"columns that occur twice: {', '.join(found)}")
