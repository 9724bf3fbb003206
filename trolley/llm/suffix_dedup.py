"""Removal of repeated byte strings by minimiser buckets and block hashes, in place of bucket-pointer refinement.

A byte is removed if a string of ``WINDOW`` bytes covers it that also starts anywhere else in the
corpus. Every window start belongs to the position in its window with the smallest hashed q-gram, its
pointer; equal windows have equal q-grams at equal distances, so they belong to the same bucket:

* Initial buckets are the q-grams at pointers. A pointer stands for all window starts that belong to
  it, a run of distances; their bytes together are its context.
* A bucket with one entry has no repeat. A bucket whose entries have one context is settled: all
  their windows repeat. So are entries of one context in any bucket; one of them goes on for all.
* All other entries are refined: their runs are cut into blocks of distances, and the new bucket is
  the identifier of the bytes that all windows of the block share (at later and earlier offsets than
  the q-gram). The step is repeated on what is not settled with blocks of one distance, where a
  bucket is a whole window. Each step reuses what the last one settled and gets only the rest.

Only pointers move, about one for 85 bytes. Buckets are found by sorting the pointers by ranges, which cut a
bucket of very many entries, and by comparing neighbours, so a passage of many documents loads no task. No bucket identifier is looked up for another suffix: each
round hashes bytes of the text again. Identifiers are 64-bit polynomial hashes of the bytes.

Rows: every input row gives one output row; a null text counts as empty. Repeated rows, also of one
``doc_id``, are copies of each other. Texts shorter than a window lose nothing.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import stored, worker_cache

WINDOW, GRAM = 200, 32
REACH = WINDOW - GRAM  # the largest distance of a window start to its pointer
#: Distances of a block in each refinement; the last must be 1.
BLOCKS = (32, 8, 1)
#: Bytes whose hashes are made together; bounds the memory of a long text.
CHUNK = 1 << 20
POSITION = np.uint64((1 << 21) - 1)
#: Texts are shuffled once, compressed at this level.
LEVEL = 1
ENTRY = "key bigint, context bigint, row_id bigint, row_hash bigint, at int, near int, far int"


class Roller:
    """Hashes of any span of bytes from prefix sums of ``table[byte] * base ** place``."""

    def __init__(self) -> None:
        draws = np.random.default_rng(20_011)
        self.table = draws.integers(0, 1 << 64, 256, np.uint64, endpoint=False)
        base = int(draws.integers(0, 1 << 62)) * 2 + 1
        size = CHUNK * 2
        for name, factor in (("power", base), ("inverse", pow(base, -1, 1 << 64))):
            factors = np.full(size, factor, np.uint64)
            factors[0] = 1
            setattr(self, name, np.multiply.accumulate(factors))

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.table[data] * self.power[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (sums[stop] - sums[start]) * self.inverse[start]


def _mixed(x: np.ndarray, *more: np.ndarray) -> np.ndarray:
    for part in (np.uint64(0), *more):
        x = (x ^ (np.asarray(part).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        x = x ^ (x >> np.uint64(31))
    return x * np.uint64(0x94D049BB133111EB)


def _roller() -> Roller:
    return worker_cache("suffix-roller", Roller)


def _entries(key, context, row_id, row_hash, at, near, far) -> pa.RecordBatch:
    columns = [pa.array(key.view(np.int64)), pa.array(context.view(np.int64)), row_id, row_hash]
    columns += [pa.array(x.astype(np.int32)) for x in (at, near, far)]
    return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in ENTRY.split(", ")])


def _pointers(data: np.ndarray, valid: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of window starts with one pointer: key, context, pointer, first and last start.

    ``valid`` marks window starts, ``cut`` those that begin a new text.
    """
    roller = _roller()
    sums = roller.sums(data)
    at = np.arange(len(data) - GRAM + 1)
    keys = _mixed(roller.spans(sums, at, at + GRAM))
    least = (keys & ~POSITION) | at.astype(np.uint64)
    width, want = 1, REACH + 1
    while width * 2 <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    starts = np.flatnonzero(valid)
    pointer = (least[starts] & POSITION).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (pointer[1:] != pointer[:-1]) | cut[starts[1:]] | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    at, lo, hi = pointer[first], starts[first], starts[last]
    context = _mixed(roller.spans(sums, lo, hi + WINDOW), at - lo, at - hi)
    return keys[at], context, at, lo, hi


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Initial entries of rows ``row_id, row_hash, text``."""
    for batch in batches:
        held: list[tuple[int, bytes]] = []
        size = 0
        for i, text in enumerate(batch.column(2).to_pylist()):
            data = (text or "").encode()
            if len(data) < WINDOW:
                continue
            if len(data) > CHUNK:
                yield from _scan_long(batch, i, data)
                continue
            if size + len(data) > CHUNK:
                yield _scan_short(batch, held)
                held, size = [], 0
            held.append((i, data))
            size += len(data)
        if held:
            yield _scan_short(batch, held)


def _scan_short(batch: pa.RecordBatch, held: list[tuple[int, bytes]]) -> pa.RecordBatch:
    lengths = np.array([len(d) for _, d in held])
    ends = np.cumsum(lengths)
    begins = ends - lengths
    data = np.frombuffer(b"".join(d for _, d in held), np.uint8)
    cut = np.zeros(len(data), bool)
    cut[begins] = True
    change = np.zeros(len(data) + 1, np.int8)
    change[begins] += 1
    change[ends - WINDOW + 1] -= 1
    key, context, at, lo, hi = _pointers(data, np.cumsum(change[:-1]) > 0, cut)
    owner = np.searchsorted(ends, at, "right")
    row = pa.array(np.array([i for i, _ in held])[owner])
    return _entries(key, context, batch.column(0).take(row), batch.column(1).take(row), at - begins[owner], at - hi, at - lo)


def _scan_long(batch: pa.RecordBatch, i: int, data: bytes) -> Iterator[pa.RecordBatch]:
    """Window starts of a long text in chunks. A run cut by a chunk's end is settled by refinement."""
    for begin in range(0, len(data) - WINDOW + 1, CHUNK):
        part = np.frombuffer(data[begin : begin + CHUNK + WINDOW - 1], np.uint8)
        valid = np.zeros(len(part), bool)
        valid[: len(part) - WINDOW + 1] = True
        key, context, at, lo, hi = _pointers(part, valid, np.zeros(len(part), bool))
        row = pa.array(np.full(len(key), i))
        yield _entries(key, context, batch.column(0).take(row), batch.column(1).take(row), at + begin, at - hi, at - lo)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``row_id, row_hash, text`` and kept columns with the text's compressed bytes in its place."""
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    for batch in batches:
        for begin in range(0, batch.num_rows, 1024):
            rows = batch.slice(begin, 1024)
            body = pa.array([compress((t or "").encode()) for t in rows.column(2).to_pylist()], pa.binary())
            names = ["row_id", "row_hash", "body", *rows.schema.names[3:]]
            yield pa.RecordBatch.from_arrays([*rows.columns[:2], body, *rows.columns[3:]], names)


def _refiner(block: int):
    """Entries of blocks of ``block`` distances for rows ``row_id, row_hash, body, at, near, far``, where the last three are arrays of a text's entries."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = _roller()
        expand = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for i in range(batch.num_rows):
                text = expand(batch.column(2)[i].as_py())
                entries = [np.array(batch.column(k)[i].as_py(), np.int64) for k in (3, 4, 5)]
                order = np.argsort(entries[0], kind="stable")
                at, near, far = (e[order] for e in entries)
                for a, b in itertools.pairwise(np.searchsorted(at, range(0, len(text) + CHUNK, CHUNK)).tolist()):
                    if a == b:
                        continue
                    begin = max(0, int(at[a]) - REACH)
                    data = np.frombuffer(text[begin : int(at[b - 1]) + WINDOW], np.uint8)
                    made = _blocks(roller, data, at[a:b] - begin, near[a:b], far[a:b], block)
                    key, context, where, lo, hi = made
                    row = pa.array(np.full(len(key), i))
                    yield _entries(key, context, batch.column(0).take(row), batch.column(1).take(row), where + begin, lo, hi)

    return refine


def _blocks(roller: Roller, data: np.ndarray, at, near, far, block: int) -> tuple[np.ndarray, ...]:
    count = far // block - near // block + 1
    which = np.repeat(np.arange(len(at)), count)
    number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + (near // block)[which]
    at = at[which]
    lo, hi = np.maximum(near[which], number * block), np.minimum(far[which], number * block + block - 1)
    sums = roller.sums(data)
    # All windows of the block share the bytes from its nearest start to its farthest start's end.
    core = roller.spans(sums, at - number * block, at - number * block - block + 1 + WINDOW)
    gram = roller.spans(sums, at, at + GRAM)
    if block == 1:  # the bucket is the whole window
        context = np.zeros(len(at), np.uint64)
    else:
        context = _mixed(roller.spans(sums, at - hi, at - lo + WINDOW), lo, hi)
    return _mixed(core, number, gram), context, at, lo, hi


OWN = ["row_id", "row_hash", "at", "near", "far"]
ORDER = ["key", "context", "row_id", "row_hash", "at"]
#: What a sorted entry becomes: a span to remove, an entry to refine, or one end of a task's run.
SETTLED, OPEN, END = 0, 1, 2


class _Sorter:
    """Sorted entries of one task to settled, open and end entries; holds a row between batches.

    A bucket is the rows of one key, a run those of one key and context. A run of several rows is settled. The first
    row of a run stands for it where its bucket has other runs. The first and the last run of a task may go on in
    another task: their first rows are ends, with the rows seen (two for all above one). A bucket at a task's edge
    counts as one with other runs, which only refines more.
    """

    def __init__(self) -> None:
        self.last: pa.RecordBatch | None = None  # the row that the next batch goes on from
        self.first: pa.RecordBatch | None = None  # the first row of its run
        self.settled = False  # whether its run has several rows, which then are given out
        self.opened = False  # whether its bucket has an earlier run
        self.runs = self.buckets = 0  # complete ones of this task

    def add(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows = batch if self.last is None else pa.Table.from_batches([self.last, batch]).combine_chunks().to_batches()[0]
        key, context = (rows.column(c).to_numpy() for c in (0, 1))
        new_key = np.append(True, key[1:] != key[:-1])
        new_run = new_key | np.append(True, context[1:] != context[:-1])
        start = np.flatnonzero(new_run)
        run = np.cumsum(new_run) - 1
        size = np.diff(np.append(start, len(key)))
        several = size > 1
        several[0] |= self.settled
        spans = several[run]
        # The held row is given out once.
        if self.last is not None and self.settled:
            spans[0] = False
        yield _given(rows.take(pa.array(np.flatnonzero(spans))), SETTLED)
        # Complete runs: all but the last one.
        bucket = np.cumsum(new_key)[start]
        other = np.zeros(len(start), bool)
        other[1:] |= bucket[1:] == bucket[:-1]
        other[:-1] |= bucket[1:] == bucket[:-1]
        other[0] |= self.opened
        if self.buckets == 0:
            other |= bucket == bucket[0]
        firsts = rows.take(pa.array(start))
        if self.first is not None:
            firsts = pa.Table.from_batches([self.first, firsts.slice(1)]).combine_chunks().to_batches()[0]
        done = other[:-1].copy()
        if self.runs == 0 and len(done):
            done[0] = False
            yield _given(firsts.slice(0, 1), END, 1 + int(several[0]))
        yield _given(firsts.take(pa.array(np.flatnonzero(done))), OPEN)
        self.opened = bool(other[-1]) if len(start) == 1 else bool(bucket[-1] == bucket[-2])
        self.runs, self.buckets = self.runs + len(start) - 1, self.buckets + int(bucket[-1] - bucket[0])
        self.last, self.first, self.settled = rows.slice(len(key) - 1), firsts.slice(len(start) - 1), bool(several[-1])

    def end(self) -> Iterator[pa.RecordBatch]:
        if self.first is not None:
            yield _given(self.first, END, 1 + int(self.settled))


def _given(rows: pa.RecordBatch, kind: int, n: int = 0) -> pa.RecordBatch:
    more = [pa.array(np.full(rows.num_rows, x, np.int32)) for x in (kind, n)]
    return pa.RecordBatch.from_arrays([*rows.columns, *more], [*rows.schema.names, "kind", "n"])


def _sort_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sorter = _Sorter()
    for batch in batches:
        if batch.num_rows:
            yield from sorter.add(batch)
    yield from sorter.end()


def _sorted_out(entries: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Settled spans to remove, and the entries to refine: one of each context of an open bucket.

    Entries are sorted by ranges of bucket, context and place, so a bucket of very many entries is cut between
    tasks, and each is compared with its neighbours only.
    """
    entries = stored(entries, f"{name}-entries")
    ordered = entries.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    given = stored(ordered.mapInArrow(_sort_out, f"{ENTRY}, kind int, n int"), name)
    # Two rows of each task: runs that go on in other tasks are put together here.
    parts = F.collect_list(F.struct(*OWN, "n")).alias("parts")
    ends = given.where(F.col("kind") == END).groupBy("key", "context").agg(F.sum("n").alias("n"), F.min(F.struct(*OWN)).alias("one"), parts)
    alone = ends.where("n > 1").select(F.inline("parts")).where("n = 1").select(*OWN)
    settled = given.where(F.col("kind") == SETTLED).select(*OWN).unionByName(alone)
    spans = settled.select(
        "row_id", "row_hash", (F.col("at") - F.col("far")).alias("a"), (F.col("at") - F.col("near") + WINDOW).alias("b")
    )
    return spans, given.where(F.col("kind") == OPEN).select(*OWN).unionByName(ends.select("one.*"))


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``body, a, b`` (arrays or null) and kept columns, to the kept columns, ``n_bytes, n_removed,
    n_spans`` and the bytes left."""
    expand = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            rows = batch.slice(begin, 256)
            out = []
            columns = (rows.column(k).to_pylist() for k in (0, 1, 2))
            for body, starts, stops in zip(*columns, strict=True):
                data = expand(body)
                removed = spans = 0
                kept, done = [], 0
                for a, b in _merged(starts, stops):
                    kept.append(data[done:a])
                    removed, spans, done = removed + b - a, spans + 1, b
                kept.append(data[done:])
                left = b"".join(kept)
                out.append((len(data), removed, spans, left, left.decode("utf-8", "ignore")))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            made = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            names = [*rows.schema.names[3:], "n_bytes", "n_removed", "n_spans", "kept_bytes", "kept_text"]
            yield pa.RecordBatch.from_arrays([*rows.columns[3:], *made], names)


def _merged(starts: list[int] | None, stops: list[int] | None) -> list[tuple[int, int]]:
    if not starts:
        return []
    a, b = np.array(starts), np.array(stops)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
    return list(zip(a[first].tolist(), b[np.append(first[1:], len(a)) - 1].tolist(), strict=True))


def remove_repeats(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``documents`` (``kept0``, ``kept1``, ...), ``n_bytes, n_removed, n_spans,
    kept_bytes``, and ``kept_text``, which is without the code points that a cut has broken."""
    kept = [F.col(f"`{c}`").alias(f"kept{i}") for i, c in enumerate(keep)]
    # Rows by id and text: rows equal in both have the same spans. One id, or none, may have very many
    # texts, so the hash alone tells them apart: 64 bits, and null ids differ from -1 in it.
    row_hash = F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text").alias("row_hash")
    rows = documents.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-1)).alias("row_id"), row_hash, "text", *kept)
    own = "row_id bigint, row_hash bigint, "
    more = "".join(f", {f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[3:])
    bodies = rows.mapInArrow(_pack, f"{own}body binary{more}")
    entries = rows.select("row_id", "row_hash", "text").mapInArrow(_scan, ENTRY)
    found, open_entries = _sorted_out(entries, "pointers")
    # Sets, not lists: repeated rows of one id and text have the same entries.
    for block in BLOCKS:
        asked = open_entries.groupBy("row_id", "row_hash").agg(F.collect_set(F.struct("at", "near", "far")).alias("e"))
        joined = bodies.select("row_id", "row_hash", "body").join(asked.hint("merge"), ["row_id", "row_hash"])
        entries = joined.select("row_id", "row_hash", "body", "e.at", "e.near", "e.far").mapInArrow(_refiner(block), ENTRY)
        spans, open_entries = _sorted_out(entries, f"blocks-{block}")
        found = found.unionByName(spans)
    cuts = found.groupBy("row_id", "row_hash").agg(F.collect_set(F.struct("a", "b")).alias("pairs"))
    joined = bodies.join(cuts.hint("merge"), ["row_id", "row_hash"], "left")
    schema = f"{more[2:]}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_bytes binary, kept_text string"
    names = [f"kept{i}" for i in range(len(keep))]
    return joined.select("body", "pairs.a", "pairs.b", *names).mapInArrow(_cut_out, schema)


def without_repeats(documents: DataFrame) -> DataFrame:
    """``documents`` with the repeats cut out of ``text``; ``n_chars`` is counted anew."""
    others = [c for c in documents.columns if c not in ("text", "n_chars")]
    left = remove_repeats(documents, others)
    columns = {c: F.col(f"kept{i}") for i, c in enumerate(others)}
    columns |= {"text": F.col("kept_text"), "n_chars": F.char_length("kept_text").cast("bigint")}
    return left.select(*[columns[c].alias(c) for c in documents.columns])


def removal_digest(documents: DataFrame) -> DataFrame:
    return remove_repeats(documents, ["doc_id"]).select(
        F.col("kept0").cast("bigint").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256")
    )
