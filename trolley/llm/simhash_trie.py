"""Near duplicates by SimHash and a self-join of the fingerprints' binary trie.

A text's words are what lies between ASCII white space, with A-Z in lower case. Each run of ``SHINGLE``
words, joined by single spaces, has its XXH64 (seed 42); a bit of the 64-bit fingerprint is 1 where more
than half of the hashes have it. Repeated runs count each time, a shorter text is one run, and a text
without words, or null, has fingerprint zero and is linked like any other.

Two texts are linked where their fingerprints differ in at most ``BUDGET`` bits. The join runs on the
different fingerprints, so that copies cost nothing:

* Range-partitioned and sorted, they are cut to the trie's leaves: nodes (a prefix and its depth) with at
  most ``LEAF`` fingerprints, each stored as one row.
* Pairs of nodes go down together, ``STEP`` bits at a time, as a table: the pair of the root with itself
  becomes pairs of children. The bits in which two prefixes differ are counted as far as both are known,
  and a pair over the budget goes, with all pairs below it.
* A pair of leaves goes down in one task, on the sorted arrays, in the same way until its nodes hold one
  fingerprint each. What is left of the pair is linked; the task returns links that connect the same
  fingerprints, one for each at most, so dense groups stay linear.

Linked fingerprints form components. Every input row gives a row; rows without an id take part, and a
component's id is its smallest known one (null if there is none).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import stored, text_slices
from trolley.llm.graph import components

SHINGLE, BUDGET = 3, 2
# Fixed value: seed of the shingles' hash.
SEED = 42
#: Fingerprints of a leaf.
LEAF = 2048
#: Bits that a pair of nodes goes down at once.
STEP = 4
#: Sorted fingerprints that are cut to leaves together, and pairs of nodes a task expands together.
RUN, FRONTIER = 1 << 16, 1 << 20
#: Bytes whose words are held together; bounds the memory of a long text.
PIECE = 1 << 20
BITS = 64
_SPACE = re.compile(rb"[\x20\x09-\x0d]")
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _hashes(text: str) -> Iterator[list[int]]:
    """Hashes of a text's shingles, in pieces."""
    data = text.encode().translate(_LOWER)
    digest, start, held, short = xxhash.xxh64_intdigest, 0, [], True
    while start < len(data):
        # A piece ends at white space; the words that later shingles need are carried over.
        cut = _SPACE.search(data, start + PIECE)
        stop = cut.start() if cut else len(data)
        held = held + data[start:stop].split()
        start = stop
        if len(held) >= SHINGLE:
            short = False
            yield [digest(s, SEED) for s in map(b" ".join, zip(*(held[k:] for k in range(SHINGLE))))]
            held = held[1 - SHINGLE :]
    if short and held:
        yield [digest(b" ".join(held), SEED)]


def fingerprint(text: str) -> int:
    ones, n = np.zeros(BITS, np.int64), 0
    for part in _hashes(text):
        bits = np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _add_fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``doc_id, text`` to ``doc_id, print``."""
    for batch in batches:
        for rows, texts in text_slices(batch):
            prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(prints)], ["doc_id", "print"])


def _prefixes(x: np.ndarray, depth: int) -> np.ndarray:
    return x >> np.uint64(BITS - depth) if depth else np.zeros_like(x)


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``print`` to leaves ``leaf, prefix, depth, body``.

    A node that a run's or a partition's end cuts gives several leaves of one prefix.
    """
    held = np.zeros(0, np.uint64)

    def cut(x: np.ndarray) -> pa.RecordBatch:
        found, todo = [], [(0, len(x), 0)]
        while todo:
            a, b, depth = todo.pop()
            if b - a <= LEAF:
                found.append((a, b, depth))
                continue
            half = a + int(np.searchsorted(_prefixes(x[a:b], depth + 1), _prefixes(x[b - 1 : b], depth + 1)[0]))
            # With one child the node only gets deeper.
            todo += [(a, half, depth + 1), (half, b, depth + 1)] if half > a else [(a, b, depth + 1)]
        prefix = [int(x[a]) >> (BITS - d) << (BITS - d) for a, _, d in found]
        columns = [
            pa.array(x[[a for a, _, _ in found]].view(np.int64)),
            pa.array(np.array(prefix, np.uint64).view(np.int64)),
            pa.array([d for _, _, d in found], pa.int32()),
            pa.array([x[a:b].tobytes() for a, b, _ in found], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["leaf", "prefix", "depth", "body"])

    for batch in batches:
        held = np.concatenate([held, batch.column(0).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)])
        while len(held) >= RUN:
            yield cut(held[:RUN])
            held = held[RUN:]
    if len(held):
        yield cut(held)


def _cut(prefix: str | Column, depth: Column) -> Column:
    """The first ``depth`` bits of a number, the others zero."""
    value = F.col(prefix) if isinstance(prefix, str) else prefix
    rest = (F.lit(BITS) - depth).cast("int")
    kept = F.call_function("shiftleft", F.call_function("shiftrightunsigned", value, rest), rest)
    return F.when(depth > 0, kept).otherwise(F.lit(0).cast("bigint"))


def _leaf_pairs(leaves: DataFrame) -> DataFrame:
    """``p, dp, q, dq``: pairs of leaf nodes within the budget so far, each once.

    Every step is a table of the nodes at its depth, which are at most as many as leaves, and of their pairs.
    """
    ends = leaves.select("prefix", "depth").distinct()
    deepest = ends.agg(F.max("depth").alias("d")).first()["d"]
    spark = leaves.sparkSession
    if deepest is None:
        return spark.createDataFrame([], "p bigint, dp int, q bigint, dq int")
    pairs = spark.range(1).select(*[F.lit(0).cast(t).alias(c) for c, t in (("p", "bigint"), ("dp", "int"), ("q", "bigint"), ("dq", "int"))])
    for depth in range(0, deepest, STEP):

        def at(d: int) -> Column:
            return F.least(F.col("depth"), F.lit(d))

        below = ends.select(
            _cut("prefix", at(depth)).alias("node"), at(depth).alias("node_depth"),
            _cut("prefix", at(depth + STEP)).alias("child"), at(depth + STEP).alias("child_depth"),
        ).distinct()
        left, right = (below.toDF(*[f"{c}_{side}" for c in below.columns]) for side in "pq")
        pairs = pairs.join(left, (F.col("p") == F.col("node_p")) & (F.col("dp") == F.col("node_depth_p")))
        pairs = pairs.join(right, (F.col("q") == F.col("node_q")) & (F.col("dq") == F.col("node_depth_q")))
        both = F.least("child_depth_p", "child_depth_q")
        differ = F.bit_count(_cut(F.col("child_p").bitwiseXOR(F.col("child_q")), both))
        # A pair of a node with itself becomes each pair of its children once.
        twin = (F.col("p") == F.col("q")) & (F.col("dp") == F.col("dq"))
        once = ~twin | (F.struct("child_p", "child_depth_p") <= F.struct("child_q", "child_depth_q"))
        pairs = pairs.where((differ <= BUDGET) & once).select(
            F.col("child_p").alias("p"), F.col("child_depth_p").alias("dp"), F.col("child_q").alias("q"), F.col("child_depth_q").alias("dq")
        )
        pairs = stored(pairs, "node-pairs")
    return pairs


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sorted arrays ``a`` and ``b`` whose numbers differ in at most ``BUDGET`` bits.

    With ``same`` both are one array and each pair comes once.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    # Pairs of nodes: ranges of both arrays, and the depth of both.
    todo = [(np.array([[0], [len(a)], [0], [len(b)]]), 0)] if len(a) and len(b) else []
    while todo:
        pairs, depth = todo.pop()
        if ((pairs[1] - pairs[0] == 1) & (pairs[3] - pairs[2] == 1)).all():
            i, j = pairs[0], pairs[2]
            near = np.bitwise_count(a[i] ^ b[j]) <= BUDGET
            if same:
                near &= i < j
            found.append((i[near], j[near]))
            continue
        depth += STEP
        pa_, pb = _prefixes(a, depth), _prefixes(b, depth)
        runs = [np.append(np.flatnonzero(np.append(True, p[1:] != p[:-1])), len(p)) for p in (pa_, pb)]
        first = [np.searchsorted(r, x) for r, x in zip(runs, (pairs[0], pairs[2]), strict=True)]
        count = [np.searchsorted(r, x) - f for r, x, f in zip(runs, (pairs[1], pairs[3]), first, strict=True)]
        total = count[0] * count[1]
        for x in np.split(np.arange(len(total)), np.flatnonzero(np.diff(np.cumsum(total) // FRONTIER)) + 1):
            owner = np.repeat(x, total[x])
            k = np.arange(len(owner)) - np.repeat(np.cumsum(total[x]) - total[x], total[x])
            i, j = first[0][owner] + k // count[1][owner], first[1][owner] + k % count[1][owner]
            keep = np.bitwise_count(pa_[runs[0][i]] ^ pb[runs[1][j]]) <= BUDGET
            if same:
                keep &= i <= j
            i, j = i[keep], j[keep]
            if len(i):
                todo.append((np.stack([runs[0][i], runs[0][i + 1], runs[1][j], runs[1][j + 1]]), depth))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _smallest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest place each of ``n`` places is connected with."""
    label = np.arange(n)
    while True:
        now = label.copy()
        np.minimum.at(now, i, label[j])
        np.minimum.at(now, j, label[i])
        now = np.minimum(now, now[now])
        if (now == label).all():
            return label
        label = now


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``same, body, other`` of leaf pairs to links ``a, b`` of fingerprints."""
    sign = np.uint64(1 << 63)
    for batch in batches:
        for row in batch.to_pylist():
            a, b = (np.frombuffer(row[c], np.uint64) for c in ("body", "other"))
            i, j = near_pairs(a, b, row["same"])
            both = a if row["same"] else np.concatenate([a, b])
            label = _smallest(len(both), i, j if row["same"] else j + len(a))
            moved = np.flatnonzero(label != np.arange(len(both)))
            columns = [pa.array((both[x] ^ sign).view(np.int64)) for x in (moved, label[moved])]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b"])


def links(prints: DataFrame) -> DataFrame:
    """``a, b``: links that connect the different numbers ``print`` within the budget, directly or not."""
    ordered = prints.select("print").repartitionByRange("print").sortWithinPartitions("print")
    leaves = stored(ordered.mapInArrow(_leaves, "leaf bigint, prefix bigint, depth int, body binary"), "leaves")
    pairs = _leaf_pairs(leaves)
    left, right = (leaves.toDF(*[f"{c}_{side}" for c in leaves.columns]) for side in "pq")
    met = pairs.join(left, (F.col("p") == F.col("prefix_p")) & (F.col("dp") == F.col("depth_p")))
    met = met.join(right, (F.col("q") == F.col("prefix_q")) & (F.col("dq") == F.col("depth_q")))
    twin = (F.col("p") == F.col("q")) & (F.col("dp") == F.col("dq"))
    met = met.where(~twin | (F.col("leaf_p") <= F.col("leaf_q")))
    same = (F.col("leaf_p") == F.col("leaf_q")).alias("same")
    # Pairs are few and costly: dealt out evenly, whatever their leaves.
    met = met.select(same, F.col("body_p").alias("body"), F.col("body_q").alias("other"))
    return met.repartition(F.xxhash64("body", "other")).mapInArrow(_links, "a bigint, b bigint")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    prints = stored(rows.mapInArrow(_add_fingerprints, "doc_id bigint, print bigint"), "prints")
    points = stored(prints.groupBy("print").agg(F.min("doc_id").alias("first")), "points")
    found = components(stored(links(points), "links"))
    labels = points.join(found, F.col("print") == F.col("node"), "left")
    labels = stored(labels.select("print", "first", F.coalesce("component", "print").alias("component")), "labels")
    # Tables on both sides of the joins, so that Spark can split a component or a fingerprint of very many rows.
    ids = stored(labels.groupBy("component").agg(F.min("first").alias("component_id")), "component-ids")
    members = stored(labels.join(ids, "component").select("print", "component_id"), "members")
    return prints.join(members, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
