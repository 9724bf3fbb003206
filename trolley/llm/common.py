"""Small helpers the operators of this package share."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.scratch import materialize

#: Texts of at most so many bytes are turned into numpy arrays together; a longer text goes alone.
SLICE_BYTES = 2_000_000
#: Values (tables, tokenizers) a Python worker keeps.
CACHED_VALUES = 2


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def worker_cache(key: str, make: Callable[[], Any]) -> Any:
    """One value per Python worker, kept between its tasks.

    Functions sent by value get new globals in each task, so module globals would be rebuilt.
    """
    module = sys.modules.setdefault("_trolley_worker", types.ModuleType("_trolley_worker"))
    kept = module.__dict__.setdefault("kept", {})
    if key not in kept:
        while len(kept) >= CACHED_VALUES:  # an earlier stage's tables make room
            del kept[next(iter(kept))]
        kept[key] = make()
    return kept[key]


def text_slices(
    batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut a batch to runs of rows of bounded text size; null texts become empty ones."""
    place = batch.schema.get_field_index(column)
    sizes = pc.fill_null(pc.binary_length(batch.column(place)), 0).to_pylist()

    def part(start: int, stop: int) -> tuple[pa.RecordBatch, list[str]]:
        rows = batch.slice(start, stop - start)
        return rows, [t or "" for t in rows.column(place).to_pylist()]

    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield part(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield part(start, len(sizes))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Its shuffle files are removed as soon as the table is there, so that a job of several steps holds
    only the tables between them and the shuffles of one step.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key)
    conf.set(key, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(key, before)


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id has remainder 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))


def bounded_sample(
    df: DataFrame, group: str, key: str, most: int, counts: dict[Any, int], more: tuple[str, ...] = ()
) -> DataFrame:
    """A reproducible share of each group's rows: about ``most`` of them, all if there are fewer.

    ``counts`` has the rows of each group. Rows are chosen by the hash of ``key``, so no group is
    sorted or gathered and a repeated task chooses the same rows. Where many rows may share a key, or have none,
    ``more`` names columns that tell them apart.
    """
    scale = 1 << 30
    place = F.pmod(F.xxhash64(F.lit("sample"), F.col(key), *more), F.lit(scale))
    limit = F.lit(0)
    for value, n in counts.items():
        share = min(scale, int(scale * most / max(n, 1)))
        limit = F.when(F.col(group).eqNullSafe(F.lit(value)), F.lit(share)).otherwise(limit)
    return df.where(place < limit)
