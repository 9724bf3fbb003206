"""Quality by ordinal cumulative-link regression on graded ratings.

Grades g_0 < ... < g_K share one weight vector over hashed text features; ordered thresholds t_k give
P(grade > g_k) = 1 / (1 + exp(t_k - w x)). A row gets its expected grade and the tail probability of
at least a wanted grade, by which documents are selected.

Fitted on the driver from a bounded sample: about ``per_grade`` rated rows of each grade, as dense
rows of ``1 << bits`` numbers. Scores read whole texts of all rows.

Rows: every input row gives one output row. A null text counts as empty. Null grades are not learned
from; a document rated twice counts twice; ratings of unknown documents have no effect. With fewer
than two grades nothing can be learned: the tail is then 1 and all rows are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bounded_sample, text_slices
from trolley.llm.features import NgramSpace
from trolley.llm.language import dense_sample

PER_GRADE = 2000
SPACE = NgramSpace(bits=12, orders=(1, 2, 3), lower=False, marks=True)
#: Documents are kept if the tail probability of the wanted grade is at least this.
KEEP_TAIL = 0.5


@dataclass
class OrdinalModel:
    grades: list[int]
    weights: np.ndarray
    mean: np.ndarray
    thresholds: np.ndarray

    @staticmethod
    def fit(rows: np.ndarray, grades: list[int], l2: float = 1e-3, steps: int = 250) -> OrdinalModel:
        levels = sorted(set(grades))
        x, mean, spread = SPACE.standardised(rows)
        y = np.array([levels.index(g) for g in grades])
        k = len(levels) - 1
        above = np.array([(y > j).mean() for j in range(k)])
        t = np.log((1 - above) / above)
        w = np.zeros(x.shape[1])
        # Each grade counts the same in all, so that a rare one is not drowned.
        share = (len(y) / len(levels) / np.bincount(y))[y] / len(y)
        rate = 1 / (0.25 * np.square(x).sum(1).mean() / 4 + l2)
        ahead_w, ahead_t = w, t
        for step in range(steps):
            tail = _tails(x @ ahead_w.astype(np.float32), ahead_t)
            hi, lo = tail[np.arange(len(y)), y], tail[np.arange(len(y)), y + 1]
            chance = np.maximum(hi - lo, 1e-12)
            slope = tail * (1 - tail)
            up, down = slope[np.arange(len(y)), y], slope[np.arange(len(y)), y + 1]
            g_score = -share * (up - down) / chance
            g_w = (x.T @ g_score.astype(np.float32)) + l2 * ahead_w
            g_t = np.zeros(k)
            np.add.at(g_t, np.maximum(y - 1, 0), np.where(y > 0, share * up / chance, 0))
            np.add.at(g_t, np.minimum(y, k - 1), np.where(y < k, -share * down / chance, 0))
            new_w, new_t = ahead_w - rate * g_w, np.maximum.accumulate(ahead_t - g_t)
            push = step / (step + 3)
            ahead_w, ahead_t = new_w + push * (new_w - w), np.maximum.accumulate(new_t + push * (new_t - t))
            w, t = new_w, new_t
        return OrdinalModel(levels, (w / spread)[:, None], mean, t)

    def predict(self, texts: list[str], wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and the probability of ``wanted`` or a higher grade."""
        tail = _tails(SPACE.linear(texts, self.weights, self.mean)[:, 0], self.thresholds)
        chance = tail[:, :-1] - tail[:, 1:]
        level = int(np.searchsorted(self.grades, wanted))
        last = np.zeros(len(texts)) if level >= len(self.grades) else tail[:, level]
        return chance @ np.array(self.grades, float), last


def _tails(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= g_j) for j = 0 .. K, and 0 behind: columns of a row never increase."""
    n = len(score)
    mid = 1 / (1 + np.exp(np.clip(thresholds[None, :] - score[:, None], -40, 40)))
    return np.hstack([np.ones((n, 1)), mid, np.zeros((n, 1))])


def fit(documents: DataFrame, labels: DataFrame, per_grade: int = PER_GRADE) -> OrdinalModel | None:
    """Learn from ``documents.text`` and ``labels.quality``, joined by ``doc_id``."""
    rated = labels.select("doc_id", "quality").where(F.col("quality").isNotNull())
    counts = {r["quality"]: r["count"] for r in rated.groupBy("quality").count().collect()}
    if len(counts) < 2:
        return None
    sample = bounded_sample(rated, "quality", "doc_id", per_grade, counts)
    # The sample has a bounded number of small rows, whatever the tables' size.
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    rows, grades = dense_sample(texts, SPACE, "quality")
    return OrdinalModel.fit(rows, grades) if len(set(grades)) > 1 else None


def score(df: DataFrame, model: OrdinalModel | None, wanted: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` with ``expected_grade`` (null without a model) and ``tail``."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch):
                grade, tail = model.predict(texts, wanted) if model else ([None] * len(texts), [1.0] * len(texts))
                kept = [rows.column(1 + i) for i in range(len(keep))]
                columns = [*kept, pa.array(grade, pa.float64()), pa.array(tail, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "expected_grade", "tail"])

    source = df.select(F.col("text").alias("_scored"), *keep)

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = ["text", *(f"kept{i}" for i in range(len(keep)))]
            yield from run(iter([batch.rename_columns(names)]))

    return source.mapInArrow(renamed, f"{schema}, expected_grade double, tail double")


def rate(documents: DataFrame, labels: DataFrame, wanted: int = 1) -> DataFrame:
    """Every document: ``doc_id, expected_grade, tail, keep``."""
    scored = score(documents, fit(documents, labels), wanted, ["doc_id"])
    return scored.withColumn("keep", F.col("tail") >= KEEP_TAIL)


def keep_good(documents: DataFrame, labels: DataFrame, wanted: int = 1) -> DataFrame:
    """The rows of ``documents`` that the classifier keeps. Rows go to Python and back once."""
    model = fit(documents, labels)
    if model is None:
        return documents
    columns = documents.columns
    names = [f"kept{i}" for i in range(len(columns))]
    text = names[columns.index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, text):
                _, tail = model.predict(texts, wanted)
                yield rows.filter(pa.array(tail >= KEEP_TAIL))

    rows = documents.toDF(*names)
    return rows.mapInArrow(run, rows.schema).toDF(*columns)
