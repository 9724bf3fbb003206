"""Token ids in plane-shuffled blocks: a file format for id streams, its writer and its reader.

A dataset has one row per block, written by Spark: ``shard``, ``block``, ``first`` (ids of the shard
before it), ``n_ids``, ``planes`` (payload), ``plane_ends`` (the chunk index: where each compressed
plane of the payload ends) and the documents with ids in it: ``ordinals`` (their places in the
shard), ``doc_ids``, ``lengths`` (ids in this block). A block has ``BLOCK`` ids, a shard's last block
fewer. Ids are transposed to 4 byte planes or 32 bit planes; each plane is compressed with zstandard.

Shards follow ascending ``doc_id`` (null first; rows of equal ids by text), so a shard's place in the
stream is the sum of the shards before it. Every row of the input is one document, repeated ids too; a
null text counts as empty and has the end id alone. An empty table gives an empty dataset.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.functions.scratch import scratch_path
from trolley.llm.common import text_slices, worker_cache

BLOCK = 1 << 16
END_ID = 0
#: Entries of a worker's cache of encoded words.
CACHED_WORDS = 400_000
#: New words that the tokenizer gets as one text.
JOINED = 256

FORMAT = (
    "shard int, block int, first bigint, n_ids int, planes binary, plane_ends array<int>, "
    "ordinals array<int>, doc_ids array<bigint>, lengths array<int>"
)
DOCUMENTS = "shard int, doc_id bigint, at bigint, ids binary"


# Fixed value: how byte-level vocabularies write the byte of a space.
SPACE = "\u0120"


class WordEncoder:
    """Whole texts by the tokenizers library, which sees each distinct word once.

    Before a space that a non-space follows, the byte-level pattern always starts a new token, so
    the text may be cut there. Texts with a literal special token are not cut. For the same reason new
    words go to the tokenizer many at once, divided by single spaces: a token that begins with a space
    is the first one of a word that has no space itself.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.spaced = np.zeros(max(vocabulary.values()) + 1, bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(SPACE)]] = True
        # A special token with a space might appear between two words of different texts.
        self.joins = not any(" " in s for s in self.special)
        self.words: dict[str, bytes] = {}
        self.odd = re.compile(r" \s| $")
        self.cut = re.compile(r" (?=\S)")

    def _ids(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _word_ids(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word behind a space."""
        alone = [w for w in words if not self.joins or " " in w]
        plain = [w for w in words if " " not in w] if self.joins else []
        groups = [plain[a : a + JOINED] for a in range(0, len(plain), JOINED)]
        found: dict[str, bytes] = {}
        for group, packed in zip(groups, self._ids([" " + " ".join(g) for g in groups]), strict=True):
            starts = np.flatnonzero(self.spaced[np.frombuffer(packed, "<u4")]) * 4
            if len(starts) == len(group):
                cuts = [*starts.tolist(), len(packed)]
                found.update(zip(group, [packed[a:b] for a, b in zip(cuts, cuts[1:], strict=False)], strict=True))
            else:  # a vocabulary without tokens of its own for spaces
                alone += group
        found.update(zip(alone, self._ids([" " + w for w in alone]), strict=True))
        return found

    def __call__(self, texts: list[str]) -> list[bytes]:
        words: list[str] = []
        heads, ends = [], []
        for text in texts:
            if any(s in text for s in self.special):
                heads.append(text)
            else:
                parts = self.cut.split(text) if self.odd.search(text) else text.split(" ")
                heads.append(parts[0])
                words += parts[1:]
            ends.append(len(words))
        packed: list = list(map(self.words.get, words))
        if None in packed:
            missing = [i for i, ids in enumerate(packed) if ids is None]
            fresh = self._word_ids(list({words[i] for i in missing}))
            for i in missing:
                packed[i] = fresh[words[i]]
            if len(self.words) + len(fresh) <= CACHED_WORDS:
                self.words.update(fresh)
        spans = zip([0, *ends], ends, strict=False)
        return [h + b"".join(packed[a:b]) for h, (a, b) in zip(self._ids(heads), spans, strict=True)]


def shuffle_planes(ids: np.ndarray, bits: bool, level: int) -> tuple[bytes, list[int]]:
    """Payload and the end of each compressed plane."""
    octets = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    planes = [row.tobytes() for row in octets]
    if bits:
        planes = [np.packbits((row >> b) & 1).tobytes() for row in octets for b in range(8)]
    compress = zstandard.ZstdCompressor(level=level).compress
    parts = [compress(p) for p in planes]
    return b"".join(parts), np.cumsum([len(p) for p in parts]).tolist()


def unshuffle_planes(payload: bytes, ends: list[int], n: int) -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    parts = [expand(payload[a:b]) for a, b in zip([0, *ends], ends, strict=False)]
    if len(parts) == 32:
        bits = [np.unpackbits(np.frombuffer(p, np.uint8), count=n) for p in parts]
        octets = [sum(bits[8 * k + b] << b for b in range(8)) for k in range(4)]
    else:
        octets = [np.frombuffer(p, np.uint8) for p in parts]
    return np.ascontiguousarray(np.stack(octets, axis=1).astype(np.uint8)).view("<u4").ravel()


class _Shard:
    """Blocks of one shard, filled document by document."""

    def __init__(self, number: int, bits: bool, level: int) -> None:
        self.number, self.bits, self.level = number, bits, level
        self.blocks = self.first = self.ordinal = self.held = 0
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int, int | None, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        while True:
            part = ids[: BLOCK - self.held]
            self.parts.append(part)
            self.docs.append((self.ordinal, doc_id, len(part)))
            self.held += len(part)
            ids = ids[len(part) :]
            if self.held == BLOCK:
                yield self.flush()
            if not len(ids):
                break
        self.ordinal += 1

    def flush(self) -> dict:
        ids = np.concatenate(self.parts)
        payload, ends = shuffle_planes(ids, self.bits, self.level)
        ordinals, doc_ids, lengths = map(list, zip(*self.docs, strict=True))
        row = {"shard": self.number, "block": self.blocks, "first": self.first, "n_ids": len(ids), "planes": payload, "plane_ends": ends, "ordinals": ordinals, "doc_ids": doc_ids, "lengths": lengths}
        self.blocks, self.first, self.held = self.blocks + 1, self.first + len(ids), 0
        self.parts, self.docs = [], []
        return row


def write_ids(df: DataFrame, path: str, tokenizer: str, bits: bool = False, level: int = 3) -> None:
    """Encode ``text``, append ``END_ID``, and write the format to ``path`` in ascending ``doc_id``.

    Documents are range-partitioned once, a partition is a shard, and a task holds one block. A task
    that is repeated writes the same shard: ranges and order depend on the rows alone.
    ``bits`` stores bit planes, else byte planes.
    """
    arrow = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int32()),
         ("planes", pa.binary()), ("plane_ends", pa.list_(pa.int32())), ("ordinals", pa.list_(pa.int32())),
         ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = worker_cache(f"word-encode {tokenizer}", lambda: WordEncoder(tokenizer))
        shard = _Shard(TaskContext.get().partitionId(), bits, level)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for rows, texts in text_slices(batch):
                for doc_id, ids in zip(rows.column(0).to_pylist(), encoder(texts), strict=True):
                    for block in shard.add(doc_id, np.frombuffer(ids + end, "<u4")):
                        yield pa.RecordBatch.from_pylist([block], arrow)
        if shard.held:
            yield pa.RecordBatch.from_pylist([shard.flush()], arrow)

    ordered = df.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FORMAT).write.option("compression", "uncompressed").parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The documents of a dataset: ``doc_id``, ``start`` (ids of all documents before it), ``ids``.

    The compressed blocks of a shard go to one task in their order, so each is decoded once and a
    document cut by a block's end is put together where it is read. A task holds a block and a document.
    The number of partitions is that of shuffles: by their compressed size they would be too few.
    """
    blocks = spark.read.schema(FORMAT).parquet(path)
    sizes = blocks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row per shard, and a shard is a partition's output: a small table by design.
    places = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("shard_start"))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = blocks.repartition(partitions, "shard").sortWithinPartitions("shard", "block")
    return ordered.mapInArrow(_documents, DOCUMENTS).join(F.broadcast(places), "shard").select(
        "doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "ids"
    )


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks in the order of shard and block to their documents."""
    names = [f.split()[0] for f in DOCUMENTS.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names)

    # The document that the next block may go on with: shard and ordinal, its id and place, its parts.
    open_key, open_row, parts = None, (None, None), []
    for batch in batches:
        for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
            shard, done = row["shard"], []
            ids = unshuffle_planes(row["planes"], row["plane_ends"], row["n_ids"]).tobytes()
            at = 0
            for ordinal, doc_id, length in zip(row["ordinals"], row["doc_ids"], row["lengths"], strict=True):
                if (shard, ordinal) != open_key:
                    if open_key is not None:
                        done.append((open_key[0], *open_row, b"".join(parts)))
                    open_key, open_row, parts = (shard, ordinal), (doc_id, row["first"] + at), []
                parts.append(ids[4 * at : 4 * (at + length)])
                at += length
            if done:
                yield table(done)
    if open_key is not None:
        yield table([(open_key[0], *open_row, b"".join(parts))])


def stored_digest(df: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``df`` to a new dataset in the shared folder, read it back, and digest each document:
    ``doc_id, start, n_tokens, ids_crc32``."""
    path = scratch_path(df.sparkSession, "token-planes")
    write_ids(df, path, tokenizer)
    return read_ids(df.sparkSession, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
