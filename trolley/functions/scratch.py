"""Cut lineage by writing a table to the cluster's shared folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder: on a cluster a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="trolley-")
    return _local_folders[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark)}/trolley/{name}-{uuid.uuid4().hex}"


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files: a job of several steps holds those of one step.

    Else they stay until the driver happens to collect its garbage.
    """
    before = spark.conf.get(_CLEANUP)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def materialize(df: DataFrame, name: str, rows_per_file: int = 0, group_bytes: int = 0) -> DataFrame:
    """Write ``df`` once and read it back: same rows for every later use, whatever is lost.

    With ``rows_per_file`` no file has more rows: bytes of a file say little of its rows where values repeat.
    ``group_bytes`` is the size of the row groups, for readers that want some of them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("maxRecordsPerFile", rows_per_file)
    if group_bytes:
        writer = writer.option("parquet.block.size", group_bytes)
    with shuffles_removed(spark):
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
