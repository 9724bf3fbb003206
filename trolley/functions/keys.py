"""Expressions on identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trolley.columns import ITEM_ID_WIDTH


def pad_id(column: Column | str, width: int = ITEM_ID_WIDTH) -> Column:
    """Left-pad an id with zeros. Longer ids are kept whole (``lpad`` alone would cut them)."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def clean_text(column: Column | str) -> Column:
    """Lower case without surrounding spaces."""
    return F.trim(F.lower(F.col(column) if isinstance(column, str) else column))


def portable_hash(*columns: Column | str) -> Column:
    """A 60-bit non-negative hash built from md5, so any SQL engine can reproduce a draw."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def hash_bucket(buckets: int | Column, *columns: Column | str) -> Column:
    """Bucket number in ``[0, buckets)``, equal for equal inputs in every run and layout."""
    size = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(portable_hash(*columns), size)
