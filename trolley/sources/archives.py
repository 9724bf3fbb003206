"""Image archives as a source: byte ranges of archives, each read by one task.

An archive is never loaded whole. A range of its bytes holds the members that begin there, so a huge archive is
read by many tasks, a task opens an archive once for each of its ranges, and there are at most as many ranges as
archives and ``RANGE_BYTES`` pieces of all bytes. Only members that the caller wants are read. An archive or
a member that can't be read is a row with an ``error``; all others are read.
"""

from __future__ import annotations

import posixpath
import zipfile
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.sources.batch_sink import file_system

# Archive and member suffixes.
ARCHIVE_GLOB = "*.zip"
IMAGE_SUFFIX = ".jpg"

#: Bytes of an archive that one task reads.
RANGE_BYTES = 64 << 20
# Bytes handed on at once while reading members.
_CHUNK_BYTES = 4 << 20

MEMBER_SCHEMA = "archive string, path string, entry string, member string, size bigint, error string"
CONTENT_SCHEMA = "archive string, member string, content binary, error string"


def _open(path: str):
    """A seekable stream on any file system Spark lists from."""
    system, inner = file_system(path)
    return system.open_input_file(inner)


def is_safe_image(entry: str) -> bool:
    """A jpg entry that does not point outside its folder."""
    return entry.endswith(IMAGE_SUFFIX) and ".." not in entry and not entry.startswith("/")


def _members(archive: zipfile.ZipFile, per_archive: int | None) -> list[tuple[str, zipfile.ZipInfo]]:
    """File names and entries in name order. Folders are flattened; of equal file names the last entry counts."""
    found = {posixpath.basename(i.filename): i for i in archive.infolist() if is_safe_image(i.filename)}
    return sorted(found.items())[:per_archive]


def _said(problem: Exception) -> str:
    return f"{type(problem).__name__}: {problem}"


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Path and length of every archive below ``folder`` but files without a byte; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", ARCHIVE_GLOB)
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )


def archive_ranges(spark: SparkSession, folder: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``path, start, stop``: byte ranges of about equal size that cover every archive."""
    pieces = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1))
    ranges = list_archives(spark, folder).withColumn("pieces", pieces)
    ranges = ranges.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))

    def edge(number):
        return F.floor(F.col("length") * number / F.col("pieces")).cast("bigint")

    return ranges.select("path", edge(F.col("piece")).alias("start"), edge(F.col("piece") + 1).alias("stop"))


def _spread(ranges: DataFrame) -> DataFrame:
    """Ranges over tasks. The number of partitions is fixed (that of shuffles): the list of ranges is tiny against
    what it stands for, so adaptive execution would put it into one task."""
    partitions = int(ranges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ranges.repartition(partitions, "path", "start")


def list_members(spark: SparkSession, folder: str, per_archive: int | None = None) -> DataFrame:
    """One row per image in the archives: archive, path, entry, file name, size.

    An archive whose directory can't be read is one row with its ``error`` and no member. ``per_archive`` keeps
    the first ones of each archive in name order.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [f.split()[0] for f in MEMBER_SCHEMA.split(", ")]
        for frame in frames:
            for path in frame["path"]:
                name = posixpath.basename(path)
                try:
                    with _open(path) as stream, zipfile.ZipFile(stream) as archive:
                        rows = [(name, path, i.filename, member, i.file_size, None) for member, i in _members(archive, per_archive)]
                except Exception as problem:
                    rows = [(name, path, None, None, None, _said(problem))]
                yield pd.DataFrame(rows, columns=names)

    return _spread(archive_ranges(spark, folder).where("start = 0")).mapInPandas(run, MEMBER_SCHEMA)


def read_archives(
    spark: SparkSession, folder: str, per_archive: int | None = None, range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """Contents of the images: archive, file name, bytes, and the ``error`` of what can't be read.

    An archive whose directory can't be read is one row without a member.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.to_pylist():
                rows, held = [], 0
                for row in _contents(part["path"], part["start"], part["stop"], per_archive):
                    rows.append(row)
                    held += len(row[2] or b"")
                    if held >= _CHUNK_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    return _spread(archive_ranges(spark, folder, range_bytes)).mapInArrow(run, CONTENT_SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    archive, member, content, error = zip(*rows, strict=True)
    columns = [pa.array(archive, pa.string()), pa.array(member, pa.string()), pa.array(content, pa.binary()), pa.array(error, pa.string())]
    return pa.RecordBatch.from_arrays(columns, ["archive", "member", "content", "error"])


def _contents(path: str, start: int, stop: int, per_archive: int | None) -> Iterator[tuple]:
    """The members that begin in the range."""
    name = posixpath.basename(path)
    try:
        with _open(path) as stream, zipfile.ZipFile(stream) as archive:
            for member, info in _members(archive, per_archive):
                if start <= info.header_offset < stop:
                    try:
                        yield name, member, archive.read(info), None
                    except Exception as problem:
                        yield name, member, None, _said(problem)
    except Exception as problem:
        if start == 0:  # once for each archive
            yield name, None, None, _said(problem)
