"""Vectors for items without a purchase: a ridge map from item features to retrieval factors.

Tasks add up the products of features with features and with factors; one small system, as wide as the
features, is solved on the driver. The map gives every item with features a vector in the space of the users' factors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: weight of the penalty in shares of a feature's mean square.
RIDGE = 0.01


def _rows(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    matrix = values.reshape(len(column), -1)
    return np.where(np.isfinite(matrix), matrix, 0.0)


def _with_one(matrix: np.ndarray) -> np.ndarray:
    return np.hstack([matrix, np.ones((len(matrix), 1))])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``features, factors`` to the task's sums of products, and its rows."""
    total = None
    n = 0
    for batch in batches:
        if batch.num_rows:
            x, y = _with_one(_rows(batch.column(0))), _rows(batch.column(1))
            own = x.T @ np.hstack([x, y])
            total, n = own if total is None else total + own, n + len(x)
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()]), pa.array([n])], ["sums", "n"])


def fit_feature_map(
    features: DataFrame, factors: DataFrame, key: str, feature: str, factor: str, ridge: float = RIDGE
) -> np.ndarray | None:
    """A row for each feature and one for the constant, a column for each factor; None without a common key.

    Feature vectors have one length, as have factors; elements that are null or not finite count as 0.
    """
    both = features.select(key, feature).join(factors.select(key, factor), key)
    sums = both.select(feature, factor).where(F.col(feature).isNotNull()).mapInArrow(_products, "sums binary, n bigint")
    total = None
    for row in sums.toLocalIterator():  # one for each task, as wide as the features
        own = np.frombuffer(row["sums"], np.float64)
        total = own.copy() if total is None else total + own
    if total is None:
        return None
    # The sums are w rows of w + f numbers; f is the length of a factor.
    size = len(factors.select(factor).first()[0])
    wide = int(round((-size + np.sqrt(size * size + 4 * len(total))) / 2))
    total = total.reshape(wide, wide + size)
    square, cross = total[:, :wide], total[:, wide:]
    penalty = ridge * np.diag(square)
    penalty[-1] = 0  # the constant is free
    return np.linalg.lstsq(square + np.diag(penalty), cross, rcond=None)[0]


def mapped_vectors(features: DataFrame, weights: np.ndarray, key: str, feature: str, vector: str) -> DataFrame:
    """``key, vector``: the factors that the map gives each item with features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = _with_one(_rows(batch.column(1))) @ weights
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(made), pa.list_(pa.float64()))], [key, "made"])

    kind = dict(features.dtypes)[key]
    made = features.select(key, feature).where(F.col(feature).isNotNull()).mapInArrow(run, f"{key} {kind}, made array<double>")
    return made.select(key, F.col("made").cast("array<float>").alias(vector))
