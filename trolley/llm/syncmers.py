"""Document fingerprints from closed syncmers, in built-in expressions only.

A text is read as pieces: runs of non-spaces cut to ``PIECE`` characters from each run's start, signs of
scripts without spaces alone. A k-mer of ``K`` pieces is an anchor if the smallest hash of its inner
substrings of ``S`` pieces is its first or its last one. Whether it is one depends on its own pieces alone, so
anchors of a shared passage are the same in every document, wherever it stands. About half of all
k-mers are anchors.

``anchors`` gives them with positions, for matching passages. A fingerprint is the list of a text's distinct anchor
hashes (32 bits) in ascending order, and the likeness of two is the share of common ones among all; positions
play no part in it. A sketch is the ``SKETCH`` smallest of them, eight hexadecimal digits each. A text
without an anchor has the hash of the whole text as its only one; an empty text has an empty
list, like another empty one (1) and unlike all others (0).

Rows: every input row is one document; a null text counts as empty. Documents are ordered by
``doc_id`` (null first), rows of one id by text. A text's pieces are held in memory, one text at a
time: some hundred bytes for each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.functions.ordered import dense_index

K, S = 5, 2
SPAN = K - S + 1  # inner substrings of a k-mer; the sliding minimum doubles, so a power of two
SKETCH = 64
PIECE = 3
#: Documents whose ids differ in the lowest so many bits only are neighbours in one sort.
NEIGHBOUR_BITS = 9

# Scripts written without spaces.
UNSPACED = "\\p{IsHan}\\p{IsHiragana}\\p{IsKatakana}\\p{IsThai}\\p{IsLao}\\p{IsKhmer}\\p{IsMyanmar}"
PIECES = f"[^\\s{UNSPACED}]{{1,{PIECE}}}|[{UNSPACED}]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _shifted(values: Column, by: int) -> Column:
    return F.slice(values, F.lit(by + 1), F.size(values))


def _anchors(text: Column) -> Column:
    """Anchors of a text: position in pieces, from 1, and hash."""

    def minima(values: Column, width: int, body: Callable[[Column], Column]) -> Column:
        if width == SPAN:
            return body(values)
        wider = F.zip_with(values, _shifted(values, width), lambda a, b: F.least(a, b))
        return _let(wider, lambda m: minima(m, width * 2, body))

    def chosen(h: Column) -> Column:
        def closed(m: Column) -> Column:
            def edge(i: Column) -> Column:
                low = F.get(m, i - 1)
                return (low == F.get(h, i - 1)) | (low == F.get(h, i + SPAN - 2))

            places = F.filter(F.sequence(F.lit(1), F.size(h) - K + 1), edge)
            parts = [0, S, K - S]  # inner substrings that cover the k-mer
            return F.transform(
                places,
                lambda i: F.struct(i.alias("pos"), F.hash(*[F.get(h, i - 1 + p) for p in parts]).alias("hash")),
            )

        none = F.array().cast("array<struct<pos:int,hash:int>>")
        return F.when(F.size(h) >= K, minima(h, 1, closed)).otherwise(none)

    # As many hashes as pieces; the last ones run over the end and no k-mer uses them.
    def inner(pieces: Column) -> Column:
        return _let(F.zip_with(pieces, _shifted(pieces, 1), lambda a, b: F.xxhash64(a, b)), chosen)

    return _let(F.regexp_extract_all(text, F.lit(PIECES), F.lit(0)), inner)


def _distinct_anchors(text: Column) -> Column:
    """The sorted, distinct hashes of a text's anchors."""

    def never_empty(found: Column) -> Column:
        whole = F.when(text == "", F.array().cast("array<int>")).otherwise(F.array(F.hash(text)))
        return F.when(F.size(found) > 0, found).otherwise(whole)

    return _let(F.sort_array(F.array_distinct(_anchors(text)["hash"])), never_empty)


def _printed(hashes: Column) -> Column:
    """The fingerprint of sorted, distinct hashes."""
    return F.array_join(hashes.cast("array<string>"), " ")


def _sketched(hashes: Column) -> Column:
    """The sketch of sorted, distinct hashes."""
    digits = F.transform(F.slice(hashes, 1, SKETCH), lambda h: F.lpad(F.hex(h.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def _likeness(a: Column, b: Column) -> Column:
    """The share of common hashes of two sets of distinct ones."""

    def share(b: Column) -> Column:
        def of(common: Column) -> Column:
            union = F.size(a) + F.size(b) - common
            return F.when(union == 0, F.lit(1.0)).otherwise(common / union)

        return _let(F.size(F.array_intersect(a, b)), of)

    return _let(b, share)


def anchors(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, pos, hash``: every anchor of every text, positions in pieces from 1."""
    rows = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    found = rows.select(F.col(key), F.explode(_anchors(F.col("_text"))).alias("_anchor"))
    return found.select(key, F.col("_anchor.pos").alias("pos"), F.col("_anchor.hash").alias("hash"))


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint``."""
    rows = df.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return rows.select(key, _printed(_distinct_anchors(F.col("_text"))).alias("fingerprint"))


def _first_of_next(rows: DataFrame) -> DataFrame:
    """For each range of ids the first row of the next range that has rows (after the last: the first).

    Ranges are numbered in order by range partitioning, so nothing is sorted in one task.
    """
    ids = rows.groupBy("range").agg(F.min("place").alias("place"))
    numbers = dense_index(ids.select("range"), "range", "number")
    count = numbers.agg(F.count(F.lit(1)).alias("ranges")).scalar()
    before = numbers.select(F.col("range").alias("to_range"), F.pmod(F.col("number") - 1, count).alias("number"))
    steps = before.join(numbers, "number").select("range", "to_range")
    first = rows.join(ids.select("place"), "place").groupBy("range").agg(F.min("text").alias("first"))
    return steps.join(first.withColumnRenamed("range", "to_range"), "to_range").select("range", "first")


def with_next(documents: DataFrame) -> DataFrame:
    """Rows ``doc_id, text`` with their hashes ``own``, and of the next row ``next_text`` and ``next_own``.

    Ids are cut to ranges of ``2 ** NEIGHBOUR_BITS``: rows of a range are sorted together, and its
    last row gets its next from the few rows that are the first of a range. Hashes are worked out once a text, between
    two windows of one order, so that they are not shuffled.
    """
    # Null ids come first: they get the lowest place, which only the lowest id shares.
    place = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    rows = documents.withColumns({"place": place, "range": F.shiftright(place, NEIGHBOUR_BITS)})
    order = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    placed = rows.drop("place").withColumn("next_text", F.lead("text").over(order))
    placed = placed.withColumn("own", _distinct_anchors(F.col("text"))).withColumn("next_own", F.lead("own").over(order))
    # Texts are not null here, so only the last row of a range has no next.
    joined = placed.join(_first_of_next(rows), "range", "left")
    last = F.col("next_text").isNull()
    return joined.withColumns(
        {
            "next_own": F.when(last, _distinct_anchors(F.col("first"))).otherwise(F.col("next_own")),
            "next_text": F.when(last, F.col("first")).otherwise(F.col("next_text")),
        }
    )


def edited_likeness(documents: DataFrame) -> DataFrame:
    """Fingerprints of each document and of its edited text, whose last quarter is replaced by as many
    first characters of the next document; likeness to the edited and to the next text."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    text, n, quarter = F.col("text"), F.col("n_chars"), F.col("quarter")
    paired = with_next(rows).withColumn("n_chars", F.char_length(text))
    paired = paired.withColumn("quarter", F.floor(n / 4).cast("int"))
    fresh = F.substring(F.col("next_text"), F.lit(1), quarter)
    edited = paired.select(
        "doc_id", "own", "next_own", n.cast("bigint").alias("n_chars"),
        F.concat(F.substring(text, F.lit(1), n - quarter), fresh).alias("edited"),
    )

    def compared(other: Column) -> Column:
        return F.struct(
            _printed(F.col("own")).alias("fingerprint"),
            _printed(other).alias("edited_fingerprint"),
            _sketched(F.col("own")).alias("sketch"),
            _likeness(F.col("own"), other).alias("near_edited"),
            _likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        )

    edited = edited.withColumn("found", _let(_distinct_anchors(F.col("edited")), compared))
    return edited.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "found.*")
