"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Boundaries are found without a regular expression. Every code point gets a class; a class and what
follows it make a symbol; a symbol is a transition function on eight states. Functions compose
associatively, so all prefixes come from a blocked scan over a composition table. The slices
between boundaries are merged by rank, each distinct slice once per worker.

Rows: every input row gives one output row, also repeated ids and repeated texts. A null text
counts as empty: no ids, empty bytes. Other columns are not looked at, so their names can't clash.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import text_slices, worker_cache

#: Entries of a worker's cache of merged slices; beyond it, slices are merged again.
CACHED_SLICES = 200_000
#: Longer slices are merged with a heap and not cached.
LONG_SLICE = 64
#: A pair (byte, token) of offsets is kept for every so many slices.
OFFSET_STRIDE = 64

# Code points with the White_Space property.
WHITE_SPACE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

# Classes of code points.
LETTER, NUMBER, OTHER, SPACE, BLANK, QUOTE = range(6)
# States: at a start, inside letters, numbers, others, after a joining space, inside white space,
# and with one or two letters of a contraction to come.
START, IN_L, IN_N, IN_O, JOIN, IN_W, ONE, TWO = range(8)
# Symbols: the first three are classes; then a space before a word, another blank before a word,
# white space before white space or the end, and quotes that may open contractions.
S_L, S_N, S_O, S_JOIN, S_LAST, S_WHITE, S_ONE, S_TWO = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """Next state, and whether a slice starts at this code point."""
    if symbol == S_L and state in (ONE, TWO):
        return (START if state == ONE else ONE), False
    if symbol in (S_L, S_N, S_O):
        inside = (IN_L, IN_N, IN_O)[symbol]
        return inside, state not in (JOIN, inside)
    if symbol in (S_ONE, S_TWO):
        if state in (JOIN, IN_O):
            return IN_O, False
        return (ONE if symbol == S_ONE else TWO), True
    if symbol == S_WHITE:
        return IN_W, state != IN_W
    return (JOIN if symbol == S_JOIN else START), True


class Scanner:
    """Tables: classes of code points, transition functions and their compositions."""

    def __init__(self) -> None:
        classes = np.full(0x110000, OTHER, np.uint8)
        kinds = {"L": LETTER, "N": NUMBER}
        classes[:] = [kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)]
        classes[WHITE_SPACE] = BLANK
        classes[0x20], classes[0x27] = SPACE, QUOTE
        self.classes = classes
        steps = [[_step(state, symbol) for state in range(8)] for symbol in range(8)]
        self.starts = np.array([[s[1] for s in row] for row in steps]).ravel()
        # A text's first code point is reached from START whatever stood before.
        functions = [tuple(s[0] for s in row) for row in steps]
        functions += [(row[0][0],) * 8 for row in steps]
        ids = {f: i for i, f in enumerate(dict.fromkeys(functions))}
        self.symbol_function = np.array([ids[f] for f in functions], np.uint8)
        known = list(ids)
        for f in known:  # grows while it is read: closure under composition with symbols
            for g in functions:
                h = tuple(g[x] for x in f)
                if h not in ids:
                    ids[h] = len(known)
                    known.append(h)
        self.apply = np.array(known, np.uint8).ravel()
        self.size = len(known)
        products = [ids[tuple(g[x] for x in f)] for f in known for g in known]
        self.compose = np.array(products, np.uint8 if self.size <= 256 else np.uint16)

    def states(self, functions: np.ndarray) -> np.ndarray:
        """The state after each element, from START."""
        return self.apply[self._scan(functions).astype(np.int64) * 8 + START]

    def _scan(self, f: np.ndarray, width: int = 64) -> np.ndarray:
        """Inclusive scan under composition: inside blocks side by side, then over the blocks."""
        n = len(f)
        if n <= width:
            out = f.copy()
            for i in range(1, n):
                out[i] = self.compose[int(out[i - 1]) * self.size + int(out[i])]
            return out
        blocks = -(-n // width)
        lanes = np.zeros(blocks * width, self.compose.dtype)
        lanes[:n] = f
        lanes = np.ascontiguousarray(lanes.reshape(blocks, width).T)
        for j in range(1, width):
            lanes[j] = self.compose[lanes[j - 1].astype(np.intp) * self.size + lanes[j]]
        before = self._scan(lanes[-1])[:-1].astype(np.intp) * self.size
        lanes[:, 1:] = self.compose[before[None, :] + lanes[:, 1:]]
        return np.ascontiguousarray(lanes.T).ravel()[:n]

    def boundaries(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """UTF-8 of all texts, byte offsets of slices, and the slice number each text starts at."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        n = len(points)
        if not n:
            return b"", np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
        kind = self.classes[points]
        last = np.zeros(n, bool)
        last[ends[lengths > 0] - 1] = True
        first = np.roll(last, 1)
        white = (kind == SPACE) | (kind == BLANK)
        before_word = np.append(~white[1:], False) & ~last
        symbol = np.where(kind == QUOTE, OTHER, kind).astype(np.uint8)
        symbol[white] = S_WHITE
        symbol[white & before_word] = S_LAST
        symbol[(kind == SPACE) & before_word] = S_JOIN
        self._contractions(points, last, kind, symbol)
        f = self.symbol_function[symbol.astype(np.intp) + 8 * first]
        before = np.empty(n, np.uint8)
        before[0] = START
        before[1:] = self.states(f)[:-1]
        before[first] = START
        starts = np.flatnonzero(self.starts[symbol.astype(np.intp) * 8 + before])
        width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        at = np.concatenate(([0], np.cumsum(width)))
        offsets = np.append(at[starts], at[-1])
        text_slice = np.searchsorted(starts, np.concatenate(([0], ends)))
        return joined.encode(), offsets, text_slice

    @staticmethod
    def _contractions(points: np.ndarray, last: np.ndarray, kind: np.ndarray, symbol: np.ndarray) -> None:
        """Mark quotes with one or two fitting letters behind them in the same text."""
        quotes = np.flatnonzero((kind == QUOTE) & ~last)
        if not len(quotes):
            return
        one = points[quotes + 1]
        has_two = ~last[quotes + 1]
        two = np.where(has_two, points[np.minimum(quotes + 2, len(points) - 1)], 0)
        # The contractions of the pattern.
        is_one = np.isin(one, [ord(c) for c in "stmd"])
        is_two = np.zeros(len(quotes), bool)
        for a, b in ("re", "ve", "ll"):
            is_two |= (one == ord(a)) & (two == ord(b))
        symbol[quotes[is_one]] = S_ONE
        symbol[quotes[is_two]] = S_TWO


def merge_slice(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one slice: the adjacent pair of lowest rank is merged first, leftmost of equals."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > LONG_SLICE:
        return _merge_long(piece, ranks)
    parts = [piece[i : i + 1] for i in range(len(piece))]
    pairs = [ranks.get(a + b) for a, b in itertools.pairwise(parts)]
    while found := [r for r in pairs if r is not None]:
        i = pairs.index(min(found))
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i < len(pairs):
            pairs[i] = ranks.get(parts[i] + parts[i + 1])
        if i:
            pairs[i - 1] = ranks.get(parts[i - 1] + parts[i])
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap of (rank, place) over linked parts."""
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, to = heapq.heappop(heap)
        j = end[i] if alive[i] else n
        if j >= n or end[j] != to:
            continue
        alive[j] = False
        end[i] = to
        if to < n:
            before[to] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ids of a rank file: one base64 token and its number a line."""
    lines = map(bytes.split, Path(path).read_bytes().splitlines())
    return {base64.b64decode(token): int(rank) for token, rank in lines}


class Encoder:
    def __init__(self, path: str) -> None:
        self.ranks = read_ranks(path)
        self.scanner = Scanner()
        self.cache: dict[bytes, bytes] = {}

    def __call__(self, texts: list[str]) -> Iterator[tuple[bytes, bytes]]:
        """For each text its ids and kept offsets, both as little-endian unsigned 32-bit numbers."""
        data, offsets, text_slice = self.scanner.boundaries(texts)
        bounds = offsets.tolist()
        pieces = [data[a:b] for a, b in itertools.pairwise(bounds)]
        get = self.cache.get
        packed = list(map(get, pieces))
        for i in [i for i, ids in enumerate(packed) if ids is None]:
            piece = pieces[i]
            if (ids := get(piece)) is None:
                ids = np.array(merge_slice(piece, self.ranks), "<u4").tobytes()
                if len(self.cache) < CACHED_SLICES and len(piece) <= LONG_SLICE:
                    self.cache[piece] = ids
            packed[i] = ids
        for a, b in itertools.pairwise(text_slice.tolist()):
            ids = packed[a:b]
            kept = np.empty((len(range(0, b - a, OFFSET_STRIDE)), 2), "<u4")
            kept[:, 0] = offsets[a:b:OFFSET_STRIDE] - offsets[a]
            sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            kept[:, 1] = (np.cumsum(sizes) - sizes)[::OFFSET_STRIDE]
            yield b"".join(ids), kept.tobytes()


class Decoder:
    def __init__(self, path: str) -> None:
        tokens = {i: t for t, i in read_ranks(path).items()}
        self.lengths = np.zeros(max(tokens) + 1, np.int64)
        for i, token in tokens.items():
            self.lengths[i] = len(token)
        self.places = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)

    def __call__(self, ids: bytes, offsets: bytes | None = None) -> bytes:
        """Bytes of the ids; kept offsets must agree with them."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return b""
        lengths = self.lengths[tokens]
        at = np.cumsum(lengths) - lengths
        if offsets:
            kept = np.frombuffer(offsets, "<u4").reshape(-1, 2)
            if not np.array_equal(at[kept[:, 1]], kept[:, 0]):
                raise ValueError("the ids don't agree with the offsets kept at encoding")
        total = int(at[-1] + lengths[-1])
        return self.flat[np.repeat(self.places[tokens] - at, lengths) + np.arange(total)].tobytes()


def encode(df: DataFrame, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``offsets``: ids of the whole text, and a (byte, token) pair for every
    ``OFFSET_STRIDE`` slices; little-endian unsigned 32-bit numbers. ``ranks`` is a rank file's path
    on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"bpe-encode {ranks}", lambda: Encoder(ranks))
        for batch in batches:
            for rows, texts in text_slices(batch):
                ids, offsets = zip(*encoder(texts), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(ids, pa.binary()), pa.array(offsets, pa.binary())],
                    ["key", "ids", "offsets"],
                )

    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = source.mapInArrow(run, f"key {kind}, ids binary, offsets binary")
    return made.withColumnRenamed("key", key)


def decode(df: DataFrame, ranks: str, key: str = "doc_id") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` bytes of rows as ``encode`` returns them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = worker_cache(f"bpe-decode {ranks}", lambda: Decoder(ranks))
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = batch.slice(start, 256)
                ids, offsets = rows.column(1).to_pylist(), rows.column(2).to_pylist()
                decoded = [decoder(i or b"", o) for i, o in zip(ids, offsets, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(decoded, pa.binary())],
                    ["key", "ids", "decoded"],
                )

    kind = df.schema[key].dataType.simpleString()
    made = df.select(F.col(key).alias("key"), "ids", "offsets").mapInArrow(
        run, f"key {kind}, ids binary, decoded binary"
    )
    return made.withColumnRenamed("key", key)


def round_trip(df: DataFrame, ranks: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one worker: ``key, ids, offsets, decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"bpe-encode {ranks}", lambda: Encoder(ranks))
        decoder = worker_cache(f"bpe-decode {ranks}", lambda: Decoder(ranks))
        for batch in batches:
            for rows, texts in text_slices(batch):
                ids, offsets = zip(*encoder(texts), strict=True)
                decoded = [decoder(i, o) for i, o in zip(ids, offsets, strict=True)]
                columns = [pa.array(c, pa.binary()) for c in (ids, offsets, decoded)]
                yield pa.RecordBatch.from_arrays([rows.column(0), *columns], ["key", "ids", "offsets", "decoded"])

    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = source.mapInArrow(run, f"key {kind}, ids binary, offsets binary, decoded binary")
    return made.withColumnRenamed("key", key)


def round_trip_digest(df: DataFrame, ranks: str) -> DataFrame:
    """Per row: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    return round_trip(df, ranks).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
