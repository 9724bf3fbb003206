"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lowers case, strips accents (combining ones too) and invisible signs (Unicode's Mn and Cf), maps
look-alike letters to Latin ones and digits and signs to the letters they stand for, and turns all
else into spaces; letters divided by single signs stay divided. Lexicon entries are whole words (`` word ``) or word beginnings (`` begin``); exception phrases are two
words of which one is in the lexicon but which together are harmless: they take their hits away.

Entries, weights and exceptions are learned from labelled rows: document counts of each entry by
label, a likelihood-ratio test, smoothed log-odds. The score is a logistic function of the hits'
weights, in all and normalised by the text's length. Learned from a bounded sample: all labelled
rows up to about ``SAMPLE`` of each label, chosen by the hash of the id; counts are made on the
executors and at most ``LEXICON`` entries and ``EXCEPTIONS`` phrases come to the driver.

Rows: every input row gives one output row. Null texts count as empty and get the score of no hits.
A document labelled twice counts twice; labels of unknown documents have no effect. Where nothing can
be learned, scores are the share of toxic labels (0 without labels).
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import bounded_sample, crc_remainder, text_slices, worker_cache

SAMPLE = 4000
LEXICON = 4000
EXCEPTIONS = 2000
#: An entry must be in so many toxic rows, and its likelihood ratio (2 ln) must reach LEAST_RATIO.
LEAST_ROWS = 3
LEAST_RATIO = 26.0
LEAST_ODDS = 1.5
BEGINNINGS = (4, 5, 6, 7)
ANY_HIT = "*"

# Look-alikes outside the Latin letters, and what digits and signs stand for.
LOOK_ALIKES = str.maketrans(
    "абвгеёзиіїјкмнопрстухуѕԁԛԝһ" "αβεηικμνορτυχω" "ıłøđ",
    "abbreezuiijkmhonpctyxysdqwh" "abenikuvoptuxw" "ilod",
)
STANDS_FOR = str.maketrans("013457@$€!|", "oieastaseil")


def _table() -> np.ndarray:
    """Folded code point of every code point; 32 where none is left, 0 where it is taken out."""
    out = np.full(0x110000, 32, np.uint32)
    for c in (*range(0x30000), *range(0xE0000, 0xE1000)):
        if 0xD800 <= c < 0xE000:
            continue
        if unicodedata.category(chr(c)) in ("Mn", "Cf"):
            out[c] = 0
            continue
        base = unicodedata.normalize("NFKD", chr(c))[:1].lower().translate(LOOK_ALIKES)[:1]
        base = base.translate(STANDS_FOR)
        if base.isalnum():
            out[c] = ord(base)
    return out


class Folder:
    def __init__(self) -> None:
        self.table = _table()

    def __call__(self, text: str) -> str:
        points = self.table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        return " " + points[points != 0].tobytes().decode("utf-32-le") + " "


def _folder() -> Folder:
    return worker_cache("toxicity-folder", Folder)


def entries_of(folded: str) -> set[str]:
    out = set()
    for word in set(folded.split()):
        out.add(f" {word} ")
        out.update(f" {word[:n]}" for n in BEGINNINGS if len(word) >= n)
    return out


def likelihood_ratio(a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    """2 ln of the likelihood ratio of a in n against b in m."""
    p = (a + b) / (n + m)

    def part(k: np.ndarray, size: int) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            yes = np.where(k > 0, k * np.log(k / size / p), 0)
            no = np.where(size > k, (size - k) * np.log((size - k) / size / (1 - p)), 0)
        return np.nan_to_num(yes) + np.nan_to_num(no)

    return 2 * (part(a, n) + part(b, m))


def log_odds(a: np.ndarray, b: np.ndarray, n: int, m: int) -> np.ndarray:
    return np.log((a + 0.5) / (n - a + 0.5)) - np.log((b + 0.5) / (m - b + 0.5))


@dataclass
class ToxicityModel:
    lexicon: dict[str, float]
    exceptions: frozenset[str]
    weights: np.ndarray
    base: float

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for entry, weight in self.lexicon.items():
            machine.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            machine.add_word(phrase, (len(phrase), None))
        machine.make_automaton()
        return machine

    def hits(self, machine, folded: str) -> dict[int, float]:
        """Place and weight of each hit word; the heaviest entry of a word counts."""
        found: dict[int, float] = {}
        spans = []
        for end, (length, weight) in machine.iter(folded) if len(machine) else ():
            start = end - length + 1
            if weight is None:
                spans.append((start, end))
            elif weight > found.get(start, 0.0):
                found[start] = weight
        for a, b in spans:
            for place in [p for p in found if a <= p < b]:
                del found[place]
        return found

    def measures(self, machine, text: str) -> list[float]:
        hits = self.hits(machine, _folder()(text))
        words = text.count(" ") + text.count("\n") + 1
        total = sum(hits.values())
        best = max(hits.values(), default=0.0)
        return [np.log1p(total), np.log1p(100 * total / words), best, float(bool(hits)), np.log1p(words), 1.0]

    def scores(self, machine, texts: list[str]) -> list[float]:
        if not self.lexicon:
            return [self.base] * len(texts)
        x = np.array([self.measures(machine, t) for t in texts])
        return (1 / (1 + np.exp(-np.clip(x @ self.weights, -40, 40)))).tolist()


def _counted(texts: DataFrame, entries, kind: str) -> DataFrame:
    """Rows of each label that have an entry: ``entry, toxic_rows, other_rows``. Entries are counted
    in each slice before they leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (Counter(), Counter())
        for batch in batches:
            for rows, slice_texts in text_slices(batch):
                for toxic, text in zip(rows.column(0).to_pylist(), slice_texts, strict=True):
                    found[toxic > 0].update(entries(_folder()(text)))
                if len(found[0]) + len(found[1]) > 300_000:
                    yield _as_batch(found)
                    found = (Counter(), Counter())
        yield _as_batch(found)

    made = texts.select("toxic", "text").mapInArrow(run, "entry string, t bigint, o bigint")
    return made.groupBy("entry").agg(F.sum("t").alias("t"), F.sum("o").alias("o"))


def _as_batch(found: tuple[Counter, Counter]) -> pa.RecordBatch:
    other, toxic = found
    names = list(toxic | other)
    return pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([other[x] for x in names], pa.int64())],
        ["entry", "t", "o"],
    )


def _choose_lexicon(counts, n: int, m: int) -> dict[str, float]:
    a, b = counts["t"].to_numpy().astype(float), counts["o"].to_numpy().astype(float)
    names = counts["entry"].to_pylist()
    ratio, odds = likelihood_ratio(a, b, n, m), log_odds(a, b, n, m)
    good = np.flatnonzero((ratio >= LEAST_RATIO) & (odds >= LEAST_ODDS))
    order = sorted(good.tolist(), key=lambda i: (-ratio[i], names[i]))[:LEXICON]
    return {names[i]: float(odds[i]) for i in order}


def _word_after(folded: str, place: int) -> str:
    """The word that follows a space, whole; empty at the end."""
    start = place
    while start < len(folded) and folded[start] == " ":
        start += 1
    stop = folded.find(" ", start)
    return folded[start : stop if stop >= 0 else len(folded)]


def _word_before(folded: str, place: int) -> str:
    """The word before a space, whole; empty at the start."""
    stop = place
    while stop > 0 and folded[stop - 1] == " ":
        stop -= 1
    return folded[folded.rfind(" ", 0, stop) + 1 : stop]


def _phrases(model: ToxicityModel):
    """Pairs of words with a hit in one of them, and a mark for a text with any."""

    machine = model.automaton()

    def entries(folded: str) -> set[str]:
        out = set()
        for place in model.hits(machine, folded):
            end = folded.find(" ", place + 1)
            word = folded[place + 1 : end]
            after, before = _word_after(folded, end), _word_before(folded, place)
            if after:
                out.add(f" {word} {after} ")
            if before:
                out.add(f" {before} {word} ")
        return out | {ANY_HIT} if out else out

    return entries


def fit(documents: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Learn from ``documents.text`` and ``labels.toxic``, joined by ``doc_id``."""
    rated = labels.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic"))
    rated = rated.where(F.col("toxic").isNotNull())
    counts = {r["toxic"]: r["count"] for r in rated.groupBy("toxic").count().collect()}
    none = ToxicityModel({}, frozenset(), np.zeros(6), 0.0)
    if set(counts) != {0, 1}:
        none.base = float(1 in counts)
        return none
    # The sample has a bounded number of small rows, whatever the tables' size.
    sample = bounded_sample(rated, "toxic", "doc_id", SAMPLE, counts)
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("toxic", "text")
    # Few rows are left of many partitions: deal them out once, for three passes.
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    if not n or not m:
        return none
    likely = _counted(texts, entries_of, "words").where(f"t >= {LEAST_ROWS} AND t * {m} > o * {n} * 2")
    none.base = n / (n + m)
    lexicon = _choose_lexicon(likely.orderBy((F.col("t") / n - F.col("o") / m).desc(), "entry").limit(LEXICON * 10).toArrow(), n, m)
    if not lexicon:
        return none
    model = ToxicityModel(lexicon, frozenset(), np.zeros(6), none.base)
    pairs = _counted(texts, _phrases(model), "pairs")
    pairs = pairs.where((F.col("entry") == ANY_HIT) | F.expr(f"o >= {LEAST_ROWS} AND t * {m} * 4 < o * {n}"))
    found = pairs.orderBy(F.col("entry") != ANY_HIT, F.col("o").desc(), "entry").limit(1 + EXCEPTIONS).toArrow()
    names, a, b = found["entry"].to_pylist(), found["t"].to_numpy().astype(float), found["o"].to_numpy().astype(float)
    if names[:1] == [ANY_HIT]:
        # Harmless if it is rarer in toxic rows than chance among the rows with a hit would have it.
        ratio = likelihood_ratio(a[1:], b[1:], int(a[0]), int(b[0])) if b[0] else np.zeros(len(names) - 1)
        model.exceptions = frozenset(x for x, r in zip(names[1:], ratio, strict=True) if r >= LEAST_RATIO)
    model.weights = _fit_weights(texts, model, counts, sizes)
    return model


def _fit_weights(texts: DataFrame, model: ToxicityModel, counts: dict, sizes: dict) -> np.ndarray:
    """Logistic weights of the measures; rows count by their label's share of all labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.automaton()
        for batch in batches:
            for rows, slice_texts in text_slices(batch):
                x = [model.measures(machine, t) for t in slice_texts]
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(x, pa.list_(pa.float64()))], ["y", "x"])

    made = texts.mapInArrow(run, "y int, x array<double>").toArrow()
    rows = sorted(zip(made["y"].to_pylist(), made["x"].to_pylist(), strict=True))
    y, x = np.array([r[0] for r in rows], float), np.array([r[1] for r in rows])
    share = np.where(y > 0, counts[1] / sizes[1], counts[0] / sizes[0])
    w = np.zeros(x.shape[1])
    share = share / share.sum()
    for _ in range(60):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (share * (p - y)) + 1e-4 * w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w = w - step * min(1.0, 2 / max(1e-9, np.abs(step).max()))
    return w


def score(df: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``df`` with the ``score`` of its ``text``."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.automaton()
        for batch in batches:
            for rows, texts in text_slices(batch):
                kept = [rows.column(1 + i) for i in range(len(keep))]
                columns = [*kept, pa.array(model.scores(machine, texts), pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, [*keep, "score"])

    return df.select("text", *keep).mapInArrow(run, f"{schema}, score double")


def held_out_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from four fifths of the ids, score all: ``doc_id, held_out, score, predicted``."""
    held_out = crc_remainder("doc_id", 5) == 0
    model = fit(documents, labels.where(~held_out))
    rows = documents.select("doc_id", "text", held_out.alias("held_out"))
    scored = score(rows, model, ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
