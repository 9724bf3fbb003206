"""Near-duplicate join on word n-grams: MinHash with fixed banding and exact verification.

Shingles are runs of ``WORDS`` lower-case words (divided by ASCII white space; a shorter text is one
shingle). Texts of equal shingle sets are one class and are compared once.

* Bands: a signature has ``TREES`` paths of ``DEPTH`` minima. The longest prefix with which pairs at the
  threshold meet in some path with the target recall (``prefix_length``, from the constants alone) is
  hashed, one hash a path; the levels below it serve estimates only. Equal hashes are shuffled together.
* Within a prefix, signatures estimate the similarity; pairs that could reach the threshold (``MARGIN``
  deviations below it) connect candidates. Only a spanning tree of them leaves the task.
* Verification: within each connected set of candidates all pairs are compared on whole shingle sets.
  Links are exact: every pair of a connected set with Jaccard similarity of the threshold or more.

A prefix or set with many classes is cut into blocks of about ``BLOCK`` classes, and each pair of
blocks is a group of its own, so no task gets more than two blocks; nothing is dropped. Pairs are
counted in the task, never emitted.

Rows: every input row gives one output row. A null text, or one without words, has no links and a
group of its own. Repeated rows are copies of each other; a null ``doc_id`` is kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.llm.common import stored, worker_cache
from trolley.llm.graph import components

WORDS = 5
THRESHOLD = 0.8
TREES, DEPTH = 24, 8
RECALL = 0.9999
#: Minima kept for estimates, one byte each, and deviations that an estimate may be under the threshold:
#: about one pair at the threshold in a million is further below, so the prefixes decide the recall.
ESTIMATES, MARGIN = 128, 5
BLOCK = 512
#: Shingles whose minima are taken together, and columns of a comparison; both bound memory.
CHUNK = 4096
NO_ID = -(1 << 63)
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


def prefix_length(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """The longest prefix at which a pair of the threshold meets in some tree with the recall."""
    for k in range(DEPTH, 0, -1):
        if 1 - (1 - threshold**k) ** TREES >= recall:
            return k
    return 1


class Hasher:
    def __init__(self) -> None:
        draws = np.random.default_rng(8_317)
        self.table = draws.integers(0, 1 << 64, 256, np.uint64)
        self.base = int(draws.integers(0, 1 << 62)) * 2 + 1
        self.factor = draws.integers(0, 1 << 32, TREES * DEPTH, np.uint32) | np.uint32(1)
        self.shift = draws.integers(0, 1 << 32, TREES * DEPTH, np.uint32)
        self.grow(1 << 16)

    def grow(self, size: int) -> None:
        for name, factor in (("power", self.base), ("inverse", pow(self.base, -1, 1 << 64))):
            factors = np.full(size, factor, np.uint64)
            factors[0] = 1
            setattr(self, name, np.multiply.accumulate(factors))

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted distinct 64-bit hashes."""
        data = np.frombuffer((text or "").lower().encode(), np.uint8)
        inside = ~SPACES[data]
        edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(start):
            return np.zeros(0, np.uint64)
        if len(data) >= len(self.power):
            self.grow(2 * len(data))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[: len(data)], out=sums[1:])
        words = _mixed((sums[stop] - sums[start]) * self.inverse[start] + (stop - start).astype(np.uint64))
        n = max(len(words) - WORDS + 1, 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(WORDS, len(words))):
            out = out * np.uint64(0x9E3779B97F4A7C15) + words[k : k + n]
        return np.unique(_mixed(out))

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        low = (shingles >> np.uint64(32)).astype(np.uint32)
        best = np.full(TREES * DEPTH, 0xFFFFFFFF, np.uint32)
        for a in range(0, len(low), CHUNK):
            values = low[a : a + CHUNK, None] * self.factor[None, :] + self.shift[None, :]
            np.minimum(best, values.min(0), out=best)
        return best

    def prefixes(self, minima: np.ndarray, length: int) -> np.ndarray:
        """A bucket of each tree: the number of the tree and the first minima on its path."""
        paths = minima.reshape(TREES, DEPTH)[:, :length].astype(np.uint64)
        out = np.arange(1, TREES + 1, dtype=np.uint64)
        for k in range(length):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + paths[:, k])
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hasher() -> Hasher:
    return worker_cache("lsh-hasher", Hasher)


def _sign(length: int):
    """Rows ``doc_id, row_id, text, row_hash`` to ``doc_id, row_id, row_hash, class, buckets, signature``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = _hasher()
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                rows = batch.slice(begin, 512)
                classes, buckets, signatures = [], [], []
                for text in rows.column(2).to_pylist():
                    shingles = hasher.shingles(text)
                    if len(shingles):
                        minima = hasher.minima(shingles)
                        classes.append(_class_of(shingles))
                        buckets.append(hasher.prefixes(minima, length).view(np.int64))
                        signatures.append((_mixed(minima[:ESTIMATES].astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes())
                    else:
                        classes.append(None)
                        buckets.append([])
                        signatures.append(None)
                columns = [rows.column(0), rows.column(1), rows.column(3), pa.array(classes, pa.int64())]
                columns += [pa.array(buckets, pa.list_(pa.int64())), pa.array(signatures, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_id", "row_hash", "class", "buckets", "signature"])

    return run


def _class_of(shingles: np.ndarray) -> int:
    """A hash of a whole shingle set."""
    places = np.arange(1, len(shingles) + 1, dtype=np.uint64)
    return int(_mixed(np.array([np.sum(_mixed(shingles * np.uint64(3) + places))]))[:1].view(np.int64)[0])


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns, of sorted batches. A run may span batches."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``bucket, i, j, class, signature`` to edges that connect likely pairs."""
    least = THRESHOLD - MARGIN * math.sqrt(THRESHOLD * (1 - THRESHOLD) / ESTIMATES)
    need = math.ceil((least + (1 - least) / 256) * ESTIMATES)
    a_side: list[int] = []
    b_side: list[int] = []
    for group in _groups(batches, 3):
        if group.num_rows < 2:
            continue
        names = group.column(3).to_numpy()
        signs = np.frombuffer(b"".join(group.column(4).to_pylist()), np.uint8).reshape(-1, ESTIMATES)
        rest = np.arange(1, len(names))
        queue, at = [0], 0
        while len(rest):
            if at == len(queue):
                queue.append(int(rest[0]))
                rest = rest[1:]
                if not len(rest):
                    break
            x = queue[at]
            at += 1
            like = np.count_nonzero(signs[rest] == signs[x], axis=1) >= need
            if like.any():
                found = rest[like]
                queue.extend(found.tolist())
                rest = rest[~like]
                a_side.extend([int(names[x])] * len(found))
                b_side.extend(names[found].tolist())
        if len(a_side) > 50_000:
            yield _edges(a_side, b_side)
            a_side, b_side = [], []
    yield _edges(a_side, b_side)


def _edges(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``component, class, copies, blocks, text`` to the same with ``shingles``; a text of another
    class (of an equal id and hash) is left out."""
    hasher = _hasher()
    for batch in batches:
        for begin in range(0, batch.num_rows, 512):
            rows = batch.slice(begin, 512)
            sets = [hasher.shingles(t) for t in rows.column(4).to_pylist()]
            own = [len(s) > 0 and _class_of(s) == c for s, c in zip(sets, rows.column(1).to_pylist(), strict=True)]
            keep = pa.array(np.flatnonzero(own))
            made = pa.array([s.tobytes() for s, o in zip(sets, own, strict=True) if o], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(k).take(keep) for k in range(4)), made],
                ["component", "class", "copies", "blocks", "shingles"],
            )


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows ``component, i, j, block, class, copies, shingles`` to ``class, links, root``: linked
    copies in other classes within this pair of blocks, and a class it is connected with there."""
    names_out: list[int] = []
    links_out: list[int] = []
    roots_out: list[int] = []
    for group in _groups(batches, 3):
        names = group.column(4).to_numpy()
        _, first = np.unique(names, return_index=True)  # a class may have several rows of one id and text
        names, side = names[first], group.column(3).to_numpy()[first]
        copies = group.column(5).to_numpy()[first]
        bodies = group.column(6).to_pylist()
        linked = _linked([np.frombuffer(bodies[i], np.uint64) for i in first])
        if group.column(1)[0].as_py() != group.column(2)[0].as_py():
            linked &= side[:, None] != side[None, :]
        names_out.extend(names.tolist())
        links_out.extend((linked @ copies).tolist())
        roots_out.extend(names[_roots(linked)].tolist())
        if len(names_out) > 50_000:
            yield _links(names_out, links_out, roots_out)
            names_out, links_out, roots_out = [], [], []
    yield _links(names_out, links_out, roots_out)


def _links(*columns: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["class", "links", "root"])


def _linked(sets: list[np.ndarray]) -> np.ndarray:
    """Which pairs reach the threshold, exactly."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    values, place = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    common = np.zeros((n, n), np.float64)
    for a in range(0, len(values), CHUNK):
        lo, hi = np.searchsorted(place, [a, a + CHUNK])
        part = np.zeros((n, min(CHUNK, len(values) - a)), np.float32)
        part[owner[lo:hi], place[lo:hi] - a] = 1
        common += part @ part.T
    # In whole numbers: common / union >= 4/5 of fixed threshold, without a rounded division.
    union = sizes[:, None] + sizes[None, :] - common
    linked = common * 1000 >= union * round(THRESHOLD * 1000)
    np.fill_diagonal(linked, False)
    return linked


def _roots(linked: np.ndarray) -> np.ndarray:
    """The first member of each member's connected set."""
    n = len(linked)
    root = np.arange(n)
    seen = np.zeros(n, bool)
    for s in range(n):
        if seen[s]:
            continue
        seen[s] = True
        queue = [s]
        while queue:
            new = np.flatnonzero(linked[queue.pop()] & ~seen)
            seen[new] = True
            root[new] = s
            queue.extend(new.tolist())
    return root


def _blocks_of(size: Column, member: Column) -> tuple[Column, Column]:
    """The block of a member of a group, and its pairs of blocks."""
    count = F.ceil(size / BLOCK)
    block = F.pmod(F.xxhash64(F.lit("block"), member), count)
    pairs = F.transform(
        F.sequence(F.lit(0).cast("bigint"), count - 1),
        lambda x: F.struct(F.least(x, block).alias("i"), F.greatest(x, block).alias("j")),
    )
    return block, pairs


def near_duplicates(documents: DataFrame) -> DataFrame:
    """``doc_id, group_id, class_id, copies, n_links``, one row per document."""
    return _grouped(documents).select("doc_id", "group_id", "class_id", "copies", "n_links")


def keep_one(documents: DataFrame) -> DataFrame:
    """The rows of ``documents`` without near duplicates: of each group the one with the smallest id
    (then text hash) stays. Rows without words stay."""
    row_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    has_words = F.coalesce(F.col("text").rlike("[^ \\t\\n\\x0B\\f\\r]"), F.lit(False))
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), row_id.alias("row_id"),
        F.xxhash64("doc_id", "text").alias("row_hash"), has_words.alias("has_words"),
    )
    found = _grouped(documents).where(F.col("group_key").isNotNull())
    chosen = found.groupBy("group_key").agg(F.min(F.struct("row_id", "row_hash")).alias("one")).select("one.*")
    # Of rows equal in id and text one is left before they are shuffled.
    order = Window.partitionBy("row_id", "row_hash").orderBy("row_id")
    single = rows.where("has_words").withColumn("copy", F.row_number().over(order)).where("copy = 1")
    kept = single.join(chosen.hint("merge"), ["row_id", "row_hash"], "left_semi")
    return kept.select("row").unionByName(rows.where("NOT has_words").select("row")).select("row.*")


def _grouped(documents: DataFrame) -> DataFrame:
    """One row per document; ``group_key`` is null without words.

    ``group_id``: the smallest id connected by links; ``class_id``: the smallest id of equal shingle
    sets; ``n_links``: other documents of the threshold's similarity or more, copies included.
    """
    row_id = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), row_id.alias("row_id"), "text", F.xxhash64("doc_id", "text").alias("row_hash"))
    schema = "doc_id bigint, row_id bigint, row_hash bigint, class bigint, buckets array<bigint>, signature binary"
    signed = stored(rows.mapInArrow(_sign(prefix_length()), schema), "signed")
    classes = signed.where(F.col("class").isNotNull()).groupBy("class").agg(
        F.min(F.struct("row_id", "row_hash")).alias("one"), F.count(F.lit(1)).alias("copies"),
        F.first("buckets").alias("buckets"), F.first("signature").alias("signature"),
    )
    # Id and text hash of one row: many classes may share an id, or have none.
    ones = [F.col("one.row_id").alias("class_id"), F.col("one.row_hash").alias("class_hash")]
    classes = stored(classes.select("class", *ones, "copies", "buckets", "signature"), "classes")
    paths = classes.select("class", F.explode("buckets").alias("bucket"))
    shared = paths.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    # A table, so that both sides are shuffled for the join and Spark can split a hot bucket's rows.
    shared = stored(shared, "shared")
    met = paths.join(shared.hint("merge"), "bucket").join(classes.select("class", "signature"), "class")
    _, pairs = _blocks_of(F.col("size"), F.col("class"))
    dealt = met.select("bucket", F.explode(pairs).alias("pair"), "class", "signature")
    dealt = dealt.select("bucket", "pair.i", "pair.j", "class", "signature").repartition("bucket", "i", "j")
    likely = dealt.sortWithinPartitions("bucket", "i", "j", "class").mapInArrow(_spanning, "a bigint, b bigint")
    candidates = components(likely.distinct()).withColumnsRenamed({"node": "class"})
    sizes = candidates.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = candidates.join(sizes, "component").join(classes.select("class", "class_id", "class_hash", "copies"), "class")
    block, pairs = _blocks_of(F.col("size"), F.col("class"))
    members = members.select(
        "component", "class", "copies", F.struct(block.alias("block"), pairs.alias("pairs")).alias("blocks"), "class_id", "class_hash"
    )
    bodies = rows.select(F.col("row_id").alias("class_id"), F.col("row_hash").alias("class_hash"), "text")
    texts = members.join(bodies, ["class_id", "class_hash"])
    kinds = {c: members.schema[c].dataType.simpleString() for c in ("component", "class", "copies", "blocks")}
    schema = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", shingles binary"
    sets = texts.select(*kinds, "text").mapInArrow(_shingle_sets, schema)
    dealt = sets.select("component", F.explode("blocks.pairs").alias("pair"), "blocks.block", "class", "copies", "shingles")
    dealt = dealt.select("component", "pair.i", "pair.j", "block", "class", "copies", "shingles")
    dealt = dealt.repartition("component", "i", "j").sortWithinPartitions("component", "i", "j", "class")
    found = stored(dealt.mapInArrow(_verified, "class bigint, links bigint, root bigint"), "verified")
    linked = components(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("class").agg(F.sum("links").alias("links"))
    own = classes.select("class", "class_id", "copies").join(counted, "class", "left")
    own = own.join(linked.withColumnRenamed("node", "class"), "class", "left")
    own = own.withColumn("component", F.coalesce("component", "class"))
    firsts = own.groupBy("component").agg(F.min("class_id").alias("group_id"))
    results = own.join(firsts, "component").select(
        "class", "class_id", "group_id", F.col("component").alias("group_key"), "copies", "links"
    )
    # One class may have very many documents: Spark splits its partition, the other side is unique.
    everyone = signed.select("doc_id", "row_id", "row_hash", "class").join(results.hint("merge"), "class", "left")
    real = lambda c: F.nullif(F.coalesce(c, "row_id"), F.lit(NO_ID))
    return everyone.select(
        "doc_id", "row_id", "row_hash", "group_key",
        real("group_id").alias("group_id"),
        real("class_id").alias("class_id"),
        F.coalesce("copies", F.lit(1)).alias("copies"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
    )
