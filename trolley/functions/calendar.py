"""Calendar expressions. Days are calendar days; the week starts on Sunday (1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, Columns

# Sunday and Saturday in the 1..7 numbering.
WEEKEND = (1, 7)


def as_event_time(column: Column | str) -> Column:
    """Parse text, dates or timestamps to a zone-free timestamp; null when malformed."""
    source = F.col(column) if isinstance(column, str) else column
    return source.try_cast("timestamp_ntz")


def is_weekend(column: Column | str) -> Column:
    return F.when(F.dayofweek(column).isin(*WEEKEND), 1).otherwise(0)


def temporal_features(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Add ``day_of_week, month, year, is_weekend`` of the event time."""
    return df.withColumns(
        {
            "day_of_week": F.dayofweek(cols.time),
            "month": F.month(cols.time),
            "year": F.year(cols.time),
            "is_weekend": is_weekend(cols.time),
        }
    )


def micros(column: Column) -> Column:
    """Microseconds since 1970 of a zone-free timestamp, without a session time zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), column)


def from_micros(column: Column) -> Column:
    return F.timestamp_add("MICROSECOND", column, F.lit("1970-01-01").cast("timestamp_ntz"))
