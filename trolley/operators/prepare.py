"""Preparation that is fitted on one table (the training part) and applied to others.

What is fitted is a number or two for each column, found in one aggregation. Nulls and values that are not
finite take no part in it. A column without a value is left as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Limits = dict[str, tuple[float, float]]

# Fixed value: deviations from the mean beyond which a value is an outlier.
DEVIATIONS = 3.0


def _finite(column: str) -> Column:
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def _fitted(df: DataFrame, columns: Sequence[str], first: Callable, second: Callable) -> Limits:
    found = df.agg(
        *[first(_finite(c)).alias(f"first_{i}") for i, c in enumerate(columns)],
        *[second(_finite(c)).alias(f"second_{i}") for i, c in enumerate(columns)],
    ).first()
    pairs = {c: (found[f"first_{i}"], found[f"second_{i}"]) for i, c in enumerate(columns)}
    return {c: pair for c, pair in pairs.items() if None not in pair}


def fit_ranges(df: DataFrame, columns: Sequence[str]) -> Limits:
    """Least and largest value of each column."""
    return _fitted(df, columns, F.min, F.max)


def minmax_scale(df: DataFrame, ranges: Limits) -> DataFrame:
    """The fitted range becomes 0 to 1; values beyond it go beyond, a column of one value becomes 0."""

    def scaled(c: str) -> Column:
        low, high = ranges[c]
        return (F.col(c).cast("double") - low) / F.lit(float(high - low) if high > low else 1.0)

    return df.withColumns({c: scaled(c) for c in ranges})


def fit_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    return {c: mean for c, (mean, _) in _fitted(df, columns, F.avg, F.count).items()}


def impute_mean(df: DataFrame, means: dict[str, float]) -> DataFrame:
    """Nulls become the fitted mean; the column is a double then."""
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float(m))) for c, m in means.items()})


def fit_limits(df: DataFrame, columns: Sequence[str], deviations: float = DEVIATIONS) -> Limits:
    """Mean minus and plus so many population deviations of each column."""
    found = _fitted(df, columns, F.avg, F.stddev_pop)
    return {c: (mean - deviations * std, mean + deviations * std) for c, (mean, std) in found.items()}


def drop_outliers(df: DataFrame, limits: Limits) -> DataFrame:
    """Rows of which no column lies beyond its limits; a null does not, a value that is not finite does."""
    kept = F.lit(True)
    for c, (low, high) in limits.items():
        kept = kept & (F.col(c).isNull() | F.coalesce(_finite(c).between(low, high), F.lit(False)))
    return df.where(kept)
