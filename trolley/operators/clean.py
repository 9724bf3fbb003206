"""Cleaning of the three raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, ITEM_ID_WIDTH, Columns
from trolley.functions.calendar import as_event_time
from trolley.functions.keys import clean_text, pad_id
from trolley.functions.quantiles import exact_quantiles

# Types that count as numeric when filling gaps.
FILLABLE = ("int", "bigint", "double", "float")
UNKNOWN = "unknown"


def require_rows(**tables: DataFrame) -> None:
    """Raise when an input is empty. Reads at most one row of each table."""
    for name, table in tables.items():
        if table.isEmpty():
            raise ValueError(f"{name} is empty")


def string_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t == "string" and c not in set(skip)]


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [c for c, t in df.dtypes if t in FILLABLE and c not in set(skip)]


def normalize_strings(df: DataFrame, skip: Iterable[str] = ()) -> DataFrame:
    """Lower-case and trim every string column in one projection."""
    names = set(string_columns(df, skip))
    return df.select(*[clean_text(c).alias(c) if c in names else F.col(c) for c in df.columns])


def normalize_ids(
    df: DataFrame, cols: Columns = DEFAULT, width: int | None = ITEM_ID_WIDTH
) -> DataFrame:
    """User and item ids as text, items padded to ``width``."""
    changes = {}
    if cols.item in df.columns:
        changes[cols.item] = pad_id(cols.item, width) if width else F.col(cols.item).cast("string")
    if cols.user in df.columns:
        changes[cols.user] = F.col(cols.user).cast("string")
    return df.withColumns(changes) if changes else df


def dedup_lowest(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the lowest by ``order``, then by the remaining columns.

    A minimum over a struct is combined before the shuffle, so a key with any number of copies
    sends one row per task.
    """
    others = [c for c in df.columns if c not in keys]
    rest = [c for c in others if c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    picked = df.groupBy(*keys).agg(best)
    return picked.select(
        *[F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def dedup_transactions(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """One purchase per user, item and time: lowest price, then lowest channel."""
    return dedup_lowest(df, [cols.user, cols.item, cols.day], [cols.price, cols.channel])


def dedup_latest(df: DataFrame, key: str, time: str) -> DataFrame:
    """One row per key: the latest by ``time``, then the greatest by the remaining columns."""
    others = [c for c in df.columns if c not in (key, time)]
    best = F.max(F.struct(time, *others)).alias("_best")
    picked = df.groupBy(key).agg(best)
    return picked.select(
        *[F.col(c) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def clean_transactions(
    df: DataFrame, cols: Columns = DEFAULT, item_width: int | None = ITEM_ID_WIDTH
) -> DataFrame:
    """Parse time, normalise keys, drop bad rows, then drop duplicates."""
    typed = df.withColumns(
        {cols.day: as_event_time(cols.day), cols.item: F.col(cols.item).cast("string")}
    )
    named = normalize_ids(normalize_strings(typed), cols, item_width)
    valid = named.where(
        (F.col(cols.price) > 0) & F.col(cols.user).isNotNull() & F.col(cols.item).isNotNull()
    )
    return dedup_transactions(valid, cols).withColumn(cols.time, F.col(cols.day))


def impute_constant(df: DataFrame, values: Mapping[str, str] | None = None) -> DataFrame:
    """Fill string gaps: named columns with their own value, all others with ``unknown``."""
    own = dict(values or {})
    rest = {c: UNKNOWN for c in string_columns(df, own)}
    return df.fillna({**own, **rest})


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill gaps with the exact lower median of the column; an all-null column stays null.

    The medians are found when this is called, in one or a few column-pruned passes.
    """
    types = dict(df.dtypes)
    medians = exact_quantiles(df, columns) if columns else {}
    known = {c: m for c, m in medians.items() if m is not None}
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(m).cast(types[c])) for c, m in known.items()}
    )


def clean_customers(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Numbers filled with medians, text normalised, text gaps ``unknown``."""
    keyed = df.withColumn(cols.user, F.col(cols.user).cast("string"))
    filled = impute_median(keyed, numeric_columns(keyed, [cols.user]))
    return impute_constant(normalize_strings(filled))


def clean_articles(
    df: DataFrame,
    cols: Columns = DEFAULT,
    keys: Iterable[str] = ("product_code",),
    item_width: int | None = ITEM_ID_WIDTH,
) -> DataFrame:
    """Text normalised with gaps ``unknown``; numbers other than ``keys`` filled with medians."""
    keyed = df.withColumn(cols.item, F.col(cols.item).cast("string"))
    named = normalize_ids(normalize_strings(keyed), cols, item_width)
    return impute_median(impute_constant(named), numeric_columns(named, [cols.item, *keys]))


def preprocess(
    customers: DataFrame, articles: DataFrame, transactions: DataFrame, cols: Columns = DEFAULT
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean all three raw tables."""
    require_rows(transactions=transactions, customers=customers, articles=articles)
    return (
        clean_customers(customers, cols),
        clean_articles(articles, cols),
        clean_transactions(transactions, cols),
    )
