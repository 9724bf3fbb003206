"""Image archives to the embedding table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession

from trolley.columns import DEFAULT, Columns
from trolley.functions.scratch import materialize
from trolley.operators.images import (
    DEVICE_BATCH,
    Embedder,
    embed_images,
    embedding_report,
    embedding_table,
)
from trolley.sources.archives import read_archives
from trolley.sources.sinks import write_artifact, write_embeddings


def run_image_vectors(
    spark: SparkSession,
    archives: str,
    output: str,
    make_embedder: Callable[[], Embedder],
    per_archive: int | None = None,
    batch: int = DEVICE_BATCH,
    stamp=None,
    cols: Columns = DEFAULT,
) -> None:
    """Embed every image once, then write vectors and the report from the stored result.

    A broken archive counts as one failed image in the report; the others are embedded.
    """
    found = read_archives(spark, archives, per_archive)
    embedded = materialize(embed_images(found, make_embedder, batch, cols), "image-vectors")
    write_embeddings(embedding_table(embedded, stamp, cols), f"{output}/embeddings", cols)
    write_artifact(embedding_report(embedded), f"{output}/artifacts/image_report")
