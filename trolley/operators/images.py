"""Image vectors: archive members to unit vectors with a user-supplied embedding function."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, Columns
from trolley.functions.vectors import l2_normalize

# Images given to the embedding function at once.
DEVICE_BATCH = 128

# Takes the bytes of a batch; returns one vector per image, None for an unreadable image.
Embedder = Callable[[Sequence[bytes]], Sequence[Sequence[float] | None]]


def embed_images(
    images: DataFrame,
    make_embedder: Callable[[], Embedder],
    batch: int = DEVICE_BATCH,
    cols: Columns = DEFAULT,
) -> DataFrame:
    """Add ``raw_vector`` to ``(archive, member, content)`` rows; null where embedding failed.

    Rows without content are not embedded and keep the ``error`` they come with, if the column is there.

    ``make_embedder`` runs once per task, so a model is loaded once. When a batch raises or
    returns another number of vectors, its images are embedded one by one, so only those that fail
    are lost; ``error`` has their reason.
    """

    def vectors_of(embed: Embedder, contents: list[bytes]) -> list[np.ndarray | None]:
        found = list(embed(contents))
        if len(found) != len(contents):
            raise ValueError(f"{len(found)} vectors for {len(contents)} images")
        return [None if v is None else np.asarray(v, dtype=np.float64) for v in found]

    def each(embed: Embedder, contents: list[bytes]) -> Iterator[tuple[np.ndarray | None, str | None]]:
        for content in contents:
            try:
                vector = vectors_of(embed, [content])[0]
                yield vector, None if vector is not None else "no vector"
            except Exception as problem:
                yield None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embed = make_embedder()
        for rows in batches:
            # Only the images of one batch are Python objects at a time.
            for start in range(0, rows.num_rows, batch):
                part = rows.slice(start, batch)
                read = part.column(2).is_valid().to_pylist()
                contents = part.column(2).drop_null().to_pylist()
                try:
                    found = vectors_of(embed, contents) if contents else []
                    made = [(v, None if v is not None else "no vector") for v in found]
                except Exception:
                    made = list(each(embed, contents))
                rest = iter(made)
                made = [next(rest) if ok else (None, why) for ok, why in zip(read, part.column(3).to_pylist(), strict=True)]
                vectors = pa.array([vector for vector, _ in made], pa.list_(pa.float64()), from_pandas=True)
                errors = pa.array([error for _, error in made], pa.string())
                columns = [part.column(0), part.column(1), vectors, errors]
                yield pa.RecordBatch.from_arrays(columns, ["archive", "member", "raw_vector", "error"])

    error = F.col("error") if "error" in images.columns else F.lit(None).cast("string")
    source = images.select("archive", "member", "content", error.alias("error"))
    return source.mapInArrow(run, "archive string, member string, raw_vector array<double>, error string")


def embedding_table(embedded: DataFrame, stamp=None, cols: Columns = DEFAULT) -> DataFrame:
    """Item id from the file name, unit vector and time of each embedded image."""
    stem = F.regexp_extract("member", r"([^/]+)\.jpg$", 1)
    time = F.current_timestamp() if stamp is None else F.lit(stamp)
    return embedded.where(F.col("raw_vector").isNotNull()).select(
        stem.alias(cols.item),
        l2_normalize("raw_vector").cast("array<float>").alias(cols.vector),
        time.cast("timestamp_ntz").alias(cols.time),
    )


def embedding_report(embedded: DataFrame) -> DataFrame:
    """Images embedded and failed per archive."""
    return embedded.groupBy("archive").agg(
        F.count("raw_vector").alias("embedded"),
        F.count_if(F.col("raw_vector").isNull()).alias("failed"),
    )
