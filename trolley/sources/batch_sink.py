"""Numbered batches as a sink: a Python data source whose batch number is an idempotent key.

A run of the writer gives each task a file of its own below ``data`` and, when all tasks are done, one commit below
``commits`` that names those files. Readers see committed files alone, so a task or job that fails, and an attempt
that is repeated, leave nothing visible. A batch that a later run writes again replaces the earlier one as a whole:
an export can be repeated from its first batch or from any other. ``mode("overwrite")`` replaces all batches.

The driver holds one short message per task. Files that no commit names are removed when the run is aborted; those
of a run whose driver was lost stay unseen.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

FORMAT = "numbered_batches"
#: The key of a batch, which the written table has to have.
BATCH = "batch_no"
RUN = "_run"


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that Spark also reads, and the path there."""
    scheme, _, rest = path.partition(":")
    if scheme in ("s3a", "s3n"):
        path = f"s3:{rest}"
    elif scheme == "file":
        path = f"file:///{rest.lstrip('/')}"
    return fs.FileSystem.from_uri(path)


@dataclass
class Written(WriterCommitMessage):
    """The file of a task, none if it had no row."""

    file: str | None
    rows: int


class _Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite = path, overwrite
        # Runs are ordered by their start.
        self.run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file for the task, under a name no other attempt has."""
        system, root = file_system(self.path)
        task = TaskContext.get()
        name = f"{self.run}-{task.partitionId()}-{task.taskAttemptId()}.parquet"
        system.create_dir(f"{root}/data")
        writer, rows = None, 0
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                run = pa.array([self.run] * batch.num_rows, pa.string())
                stamped = pa.Table.from_arrays([*batch.columns, run], names=[*batch.schema.names, RUN])
                if writer is None:
                    writer = pq.ParquetWriter(f"{root}/data/{name}", stamped.schema, filesystem=system)
                writer.write_table(stamped)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        done = [m for m in messages if m is not None]
        content = {
            "run": self.run,
            "overwrite": self.overwrite,
            "rows": sum(m.rows for m in done),
            "files": sorted(m.file for m in done if m.file),
        }
        system.create_dir(f"{root}/commits")
        with system.open_output_stream(f"{root}/commits/{self.run}.part") as stream:
            stream.write(json.dumps(content).encode())
        system.move(f"{root}/commits/{self.run}.part", f"{root}/commits/{self.run}.json")

    def abort(self, messages: list[Written | None]) -> None:
        """Remove the run's files, those of failed attempts too."""
        system, root = file_system(self.path)
        found = system.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True))
        for info in found:
            if info.base_name.startswith(self.run):
                system.delete_file(info.path)


class NumberedBatches(DataSource):
    """``df.write.format("numbered_batches").mode("append").save(path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if BATCH not in schema.names:
            raise ValueError(f"the table has no column {BATCH}")
        if RUN in schema.names:
            raise ValueError(f"{RUN} is the sink's own column")
        return _Writer(self.options["path"], overwrite)


def write_batches(batches: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write numbered batches. Rows are range-partitioned by number, so a batch lies in one file.

    A null number is a batch of its own. Rows of a batch keep the order of their numbers alone.
    """
    batches.sparkSession.dataSource.register(NumberedBatches)
    laid_out = batches.repartitionByRange(BATCH).sortWithinPartitions(BATCH)
    laid_out.write.format(FORMAT).mode("overwrite" if overwrite else "append").save(path)


def commits(spark: SparkSession, path: str) -> list[dict]:
    """The commits that count, first to last: the last one that overwrites and all after it."""
    system, root = file_system(path)
    found = system.get_file_info(fs.FileSelector(f"{root}/commits", allow_not_found=True))
    read = []
    for info in sorted((i for i in found if i.base_name.endswith(".json")), key=lambda i: i.base_name):
        with system.open_input_stream(info.path) as stream:
            read.append(json.loads(stream.read()))
    begin = max((i for i, c in enumerate(read) if c["overwrite"]), default=0)
    return read[begin:]


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The committed batches, each as its last run left it. An unwritten or empty export has no rows."""
    files = [f"{path}/data/{name}" for commit in commits(spark, path) for name in commit["files"]]
    stamped = StructType([*schema.fields]).add(RUN, "string")
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(stamped).parquet(*files)
    # One row per batch; its scan reads two columns.
    last = rows.groupBy(BATCH).agg(F.max(RUN).alias("_last")).withColumnRenamed(BATCH, "_batch")
    same = F.col(BATCH).eqNullSafe(F.col("_batch")) & (F.col(RUN) == F.col("_last"))
    return rows.join(last, same, "left_semi").select(*schema.names)
