"""Language identification in two steps: family first, then languages of that family in pairs.

A multinomial logistic model chooses the family; one-versus-one linear support vector machines
(squared hinge) vote between its languages. Both see only hashed byte n-grams of the text.

Fitted on the driver from a bounded sample: about ``per_language`` rows of each language, chosen by
the hash of the id, as dense rows of ``1 << bits`` numbers. Predictions read whole texts of all rows.

Rows: every input row gives one output row. A null text, or one without a letter, gets ``und`` and
score 0, as all rows do where no language can be learned. Rows of null language are not learned from.
Ties of votes go to the larger margin sum, then to the smaller name. Other columns are not looked at.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bounded_sample, crc_remainder, text_slices
from trolley.llm.features import NgramSpace

PER_LANGUAGE = 800
SPACE = NgramSpace(bits=12, orders=(1, 2, 3, 4), lower=True)
UNKNOWN = "und"

# Families of language codes. A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "indo-aryan": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "uralic": "et fi hu",
    "turkic": "az kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
    "sinitic": "yue zh",
    "austronesian": "id jv ms su tl",
}


def family_of(language: str) -> str:
    code = language.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), f"only {language}")


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _descend(gradient, shape: tuple[int, ...], steps: int, rate: float) -> np.ndarray:
    """Nesterov's method from zero."""
    x, ahead = np.zeros(shape), np.zeros(shape)
    for t in range(steps):
        new = ahead - rate * gradient(ahead)
        ahead = new + t / (t + 3) * (new - x)
        x = new
    return x


def fit_logistic(x: np.ndarray, y: np.ndarray, classes: int, l2: float = 1e-3, steps: int = 80) -> np.ndarray:
    """Weights (last row: intercepts) of a multinomial logistic model."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    goal = np.eye(classes)[y]
    rate = 1 / (0.5 * np.square(x).sum(1).mean() + l2)

    def gradient(w: np.ndarray) -> np.ndarray:
        return x.T @ ((_softmax(x @ w) - goal) / len(x)).astype(x.dtype) + l2 * w

    return _descend(gradient, (x.shape[1], classes), steps, rate)


def fit_svm(x: np.ndarray, sign: np.ndarray, l2: float = 1e-3, steps: int = 80) -> np.ndarray:
    """Weights (last: intercept) of a linear support vector machine with squared hinge loss."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    rate = 1 / (2 * np.square(x).sum(1).mean() + l2)

    def gradient(w: np.ndarray) -> np.ndarray:
        slack = np.maximum(0, 1 - sign * (x @ w))
        return x.T @ (-2 * sign * slack / len(x)).astype(x.dtype) + l2 * w

    return _descend(gradient, (x.shape[1],), steps, rate)


@dataclass
class LanguageModel:
    languages: list[str]
    families: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    mean: np.ndarray
    intercepts: np.ndarray

    @staticmethod
    def fit(rows: np.ndarray, labels: list[str]) -> LanguageModel:
        languages = sorted(set(labels))
        of = [family_of(x) for x in languages]
        families = sorted(set(of))
        y = np.array([languages.index(x) for x in labels])
        x, mean, spread = SPACE.standardised(rows)
        family = np.array([families.index(f) for f in of])
        columns = list(fit_logistic(x, family[y], len(families)).T) if len(families) > 1 else []
        pairs = [p for p in itertools.combinations(range(len(languages)), 2) if of[p[0]] == of[p[1]]]
        for a, b in pairs:
            both = (y == a) | (y == b)
            columns.append(fit_svm(x[both], np.where(y[both] == a, 1.0, -1.0)))
        w = np.array(columns).reshape(len(columns), -1).T if columns else np.zeros((x.shape[1] + 1, 0))
        scaled = w[:-1] / spread[:, None]
        return LanguageModel(languages, families, pairs, scaled, mean, w[-1])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        n, m = len(texts), len(self.families) if len(self.families) > 1 else 0
        out = SPACE.linear(texts, self.weights, self.mean) + self.intercepts if self.weights.shape[1] else np.zeros((n, 0))
        chance = _softmax(out[:, :m]) if m else np.ones((n, 1))
        best = chance.argmax(1)
        members = [[i for i, x in enumerate(self.languages) if family_of(x) == f] for f in self.families]
        sure = 1 / (1 + np.exp(-2 * np.clip(out[:, m:], -30, 30)))
        votes = np.zeros((n, len(self.languages)))
        trust = np.zeros_like(votes)
        for k, (a, b) in enumerate(self.pairs):
            p = sure[:, k]
            votes[:, a] += p >= 0.5
            votes[:, b] += p < 0.5
            trust[:, a] += p
            trust[:, b] += 1 - p
        names, scores = [], []
        for i, text in enumerate(texts):
            group = members[best[i]]
            if not any(map(str.isalpha, text)):  # categories L* alone: no fractions or numerals
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            winner = max(group, key=lambda g: (votes[i, g], trust[i, g], -g))
            among = trust[i, winner] / (len(group) - 1) if len(group) > 1 else 1.0
            names.append(self.languages[winner])
            scores.append(float(min(1.0, max(0.0, chance[i, best[i]] * among))))
        return names, scores


def dense_sample(df: DataFrame, space: NgramSpace, label: str) -> tuple[np.ndarray, list]:
    """Rows of ``space`` for the texts of a bounded sample, made on the executors, and their labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, most=500_000):
                made = [r.tobytes() for r in space.rows(texts).astype(np.float16)]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(made, pa.binary())], ["label", "x"])

    kind = df.schema[label].dataType.simpleString()
    found = df.select(F.col(label).alias("label"), "text").mapInArrow(run, f"label {kind}, x binary").toArrow()
    # In the order of their contents: the model doesn't depend on the order of tasks.
    pairs = sorted(zip(found["label"].to_pylist(), found["x"].to_pylist(), strict=True))
    x = np.frombuffer(b"".join(p[1] for p in pairs), np.float16).astype(np.float32)
    return x.reshape(len(pairs), space.size + 1), [p[0] for p in pairs]


def fit(df: DataFrame, per_language: int = PER_LANGUAGE) -> LanguageModel | None:
    """Learn from ``text`` and ``lang``. One count per language comes to the driver."""
    known = df.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    if not counts:
        return None
    # By id and text: rows without an id, or of one, are drawn one by one.
    sample = bounded_sample(known, "lang", "doc_id", per_language, counts, more=("text",))
    rows, labels = dense_sample(sample, SPACE, "lang")
    return LanguageModel.fit(rows, labels) if labels else None


def predict(df: DataFrame, model: LanguageModel | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df``, with ``lang_pred`` and ``score`` of its ``text``."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch):
                names, scores = model.predict(texts) if model else ([UNKNOWN] * len(texts), [0.0] * len(texts))
                kept = [rows.column(1 + i) for i in range(len(keep))]
                columns = [*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score"])

    return df.select("text", *keep).mapInArrow(run, f"{schema}, lang_pred string, score double")


def held_out_predictions(documents: DataFrame) -> DataFrame:
    """Learn from three quarters of the ids, predict every row: ``doc_id, held_out, lang_pred, score``."""
    rows = documents.select("doc_id", "text", "lang", (crc_remainder("doc_id", 4) == 2).alias("held_out"))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows, model, ["doc_id", "held_out"])
