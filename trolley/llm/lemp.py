"""Hard negatives by coordinate pruning in length buckets.

Scores are integer inner products: every component ``x`` counts as ``floor(SCALE * x)``. For each anchor the
``POSITIVES`` best other rows of its label are found, and for each of them the first ``NEGATIVES`` rows of
another label whose score lies between 30 % and 90 % of the positive's. Higher scores come first, ties by id.

Rows of a label are range-partitioned and sorted by length and cut to buckets of at most ``BUCKET`` vectors. A
bucket is a row of an index table: ids, vectors, the largest length, and for each coordinate the list of its
vectors sorted by that coordinate of the unit vector. A search meets blocks of anchors with shelves of buckets,
longest first:

* The score an anchor still needs, divided by both lengths, is the least cosine ``c`` a vector of the bucket
  must have. A bucket that can't reach it ends the shelf.
* A unit vector with cosine ``c`` to the anchor has its coordinate ``f`` within ``q c`` plus or minus
  ``sqrt((1 - c * c) (1 - q * q))``, up to 1 (down to -1) if the anchor's own ``q`` (``-q``) is ``c`` at least. These
  ranges are looked up in the lists of the ``FOCUS`` coordinates where the anchor is largest; the vectors that
  lie in all of them are candidates, scored exactly.
* The score needed rises with what is found: the worst of the best rows so far, for negatives in
  the band of each positive, never below the band itself.

A task's best rows are merged with those of the other tasks, so results are exact. Anchors are a part of the
rows that the caller states; they are dealt out in blocks, never gathered.

Rows without a label or vector, with a null or non-finite component, with another length than most, or so large
that an inner product may not fit a long (length 2 ** 31.5 and more) take no part. Equal rows are rows of their own. A row without an
id is no anchor and comes after all ids in ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: A negative's score in hundredths of the positive's.
LOW, HIGH = 30, 90
BUCKET, SHELF, ANCHORS = 2048, 16, 512
#: Coordinates of an anchor whose lists are looked up.
FOCUS = 3
#: Slack of cosines and ranges against rounding.
SLACK = 1e-9
NO_ID = (1 << 63) - 1
#: Sums of products stay exact in doubles below this.
EXACT = float(1 << 52)


def usable(vectors: DataFrame) -> DataFrame:
    """``row, id, label, vector`` of the rows that take part, stored; ``row`` numbers them."""
    e = F.col("embedding").cast("array<double>")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.where(F.col("label").isNotNull() & e.isNotNull() & ~odd)
    scaled = F.transform(e, lambda x: F.floor(x * float(SCALE)))
    square = F.aggregate(e, F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * float(SCALE)).cast("double"), 2.0))
    ids = F.coalesce(F.col("vec_id").cast("bigint"), F.lit(NO_ID)).alias("id")
    rows = rows.select(ids, F.col("label").cast("bigint").alias("label"), scaled.alias("vector"), square.alias("square"))
    rows = rows.where(F.col("square") < float(1 << 63))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    lengths = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("vector") == lengths[0]["n"]) if lengths else rows


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``label, row, id, vector``, sorted by label and falling length, to buckets."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        if held.num_rows >= 2 * BUCKET:
            parts = list(_runs(held.combine_chunks()))
            # The last run may go on.
            yield from (_bucket(p) for p in parts[:-1])
            held = parts[-1]
    if held is not None and held.num_rows:
        yield from (_bucket(p) for p in _runs(held.combine_chunks()))


def _runs(table: pa.Table) -> Iterator[pa.Table]:
    labels = table.column("label").to_numpy()
    start = 0
    while start < len(labels):
        stop = min(start + BUCKET, int(np.searchsorted(labels, labels[start], "right")))
        yield table.slice(start, stop - start)
        start = stop


def _bucket(part: pa.Table) -> pa.RecordBatch:
    part = part.combine_chunks()
    n = part.num_rows
    matrix = _matrix(part.column("vector").chunk(0), n)
    size = np.sqrt(np.square(matrix.astype(np.float64)).sum(1))
    order = np.argsort(_unit(matrix, size), axis=0, kind="stable").T.astype(np.uint16)
    columns = [
        pa.array(part.column("label").to_numpy()[:1]),
        pa.array(part.column("row").to_numpy()[:1]),
        pa.array([float(size.max())]),
        pa.array([part.column("row").to_pylist()], pa.list_(pa.int64())),
        pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
        pa.array([np.ascontiguousarray(matrix).tobytes()], pa.binary()),
        pa.array([np.ascontiguousarray(order).tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["label", "bucket", "longest", "rows", "ids", "matrix", "lists"])


def _unit(matrix: np.ndarray, size: np.ndarray) -> np.ndarray:
    return matrix / np.where(size > 0, size, 1)[:, None]


def index(rows: DataFrame) -> DataFrame:
    """The buckets of all rows as a table."""
    by_length = rows.repartitionByRange("label", F.desc("square"), "row")
    ordered = by_length.sortWithinPartitions("label", F.desc("square"), "row").select("label", "row", "id", "vector")
    schema = "label bigint, bucket bigint, longest double, rows array<bigint>, ids array<bigint>, matrix binary, lists binary"
    return stored(ordered.mapInArrow(_cut, schema), "length-buckets")


class Bucket:
    """A bucket's vectors with their sorted coordinate lists."""

    def __init__(self, row: dict) -> None:
        self.longest, self.label = row["longest"], row["label"]
        self.rows, self.ids = np.array(row["rows"]), np.array(row["ids"])
        n = len(self.rows)
        self.matrix = np.frombuffer(row["matrix"], np.int64).reshape(n, -1)
        self.floats = self.matrix.astype(np.float64)
        self.unit = _unit(self.matrix, np.sqrt(np.square(self.floats).sum(1)))
        self.lists = np.frombuffer(row["lists"], np.uint16).reshape(-1, n)
        self.sorted: dict[int, np.ndarray] = {}

    def _values(self, f: int) -> np.ndarray:
        if f not in self.sorted:
            self.sorted[f] = self.unit[self.lists[f], f]
        return self.sorted[f]

    def candidates(self, unit: np.ndarray, focus: np.ndarray, least: float) -> np.ndarray:
        """Places of the vectors that may have a cosine of ``least`` with ``unit``."""
        ranges = []
        for f in focus:
            q = unit[f]
            span = np.sqrt(max(0.0, 1 - least * least) * max(0.0, 1 - q * q))
            low = -1.0 if -q >= least else q * least - span
            high = 1.0 if q >= least else q * least + span
            a, b = np.searchsorted(self._values(f), (low - SLACK, high + SLACK), "left")
            ranges.append((b - a, a, b, f, low - SLACK, high + SLACK))
        ranges.sort()
        _, a, b, f, _, _ = ranges[0]
        places = self.lists[f][a:b].astype(np.intp)
        for _, _, _, f, low, high in ranges[1:]:
            values = self.unit[places, f]
            places = places[(values >= low) & (values <= high)]
        return places

    def scores(self, places: np.ndarray, query: np.ndarray, length: float) -> np.ndarray:
        if length * self.longest < EXACT:
            return (self.floats[places] @ query.astype(np.float64)).astype(np.int64)
        products = self.matrix[places].astype(object) @ query.astype(object)
        return products.astype(np.int64)


class Best:
    """The ``k`` highest scores in a band, ties to smaller ids, then rows."""

    def __init__(self, k: int, low: int | None, high: int | None) -> None:
        self.k, self.low, self.high = k, low, high
        self.scores = self.ids = self.rows = np.zeros(0, np.int64)

    def needed(self) -> int | None:
        """The least score that can still get in; None: any."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        need = self.needed()
        keep = np.ones(len(scores), bool) if need is None else scores >= need
        if self.high is not None:
            keep &= scores <= self.high
        if keep.any():
            s, i, r = (np.concatenate(x) for x in ((self.scores, scores[keep]), (self.ids, ids[keep]), (self.rows, rows[keep])))
            order = np.lexsort((r, i, -s))[: self.k]
            self.scores, self.ids, self.rows = s[order], i[order], r[order]


def look_up(bests: list[Best], query: np.ndarray, buckets: list[Bucket], skip: int | None) -> None:
    """Fill ``bests`` from buckets of falling length; ``skip`` is the row that is the query's own."""
    length = float(np.sqrt(np.square(query.astype(np.float64)).sum()))
    unit = query / length if length else query.astype(np.float64)
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    for bucket in buckets:
        needs = [b.needed() for b in bests]
        need = None if None in needs else min(needs)
        reach = length * bucket.longest
        if need is not None and need > 0 and need > reach * (1 + SLACK):
            break
        least = (need / reach if reach else 0.0) - SLACK if need is not None else -1.0
        if need is not None and need > 0:
            places = bucket.candidates(unit, focus, least)
        else:  # nothing is ruled out yet
            places = np.arange(len(bucket.rows))
        if skip is not None:
            places = places[bucket.rows[places] != skip]
        scores = bucket.scores(places, query, length)
        for best in bests:
            best.add(scores, bucket.ids[places], bucket.rows[places])


def _shelf(table: pa.Table) -> list[Bucket]:
    return sorted((Bucket(r) for r in table.to_pylist()), key=lambda b: -b.longest)


def _find_positives(anchors: pa.Table, shelf: pa.Table) -> pa.Table:
    buckets, found = _shelf(shelf), []
    for a in anchors.to_pylist():
        best = Best(POSITIVES, None, None)
        look_up([best], np.array(a["vector"], np.int64), buckets, a["row"])
        found += [(a["row"], int(i), int(r), int(s)) for s, i, r in zip(best.scores, best.ids, best.rows, strict=True)]
    return _table(found, ("row", "positive_id", "positive_row", "positive_score"))


def _find_negatives(anchors: pa.Table, shelf: pa.Table) -> pa.Table:
    buckets, found = _shelf(shelf), []
    for a in anchors.to_pylist():
        bests = {p["positive_row"]: Best(NEGATIVES, -(-LOW * p["positive_score"] // 100), HIGH * p["positive_score"] // 100) for p in a["positives"]}
        bests = {p: b for p, b in bests.items() if b.low <= b.high}
        others = [b for b in buckets if b.label != a["label"]]
        if bests and others:
            look_up(list(bests.values()), np.array(a["vector"], np.int64), others, None)
        for p, b in bests.items():
            found += [(a["row"], p, int(i), int(r), int(s)) for s, i, r in zip(b.scores, b.ids, b.rows, strict=True)]
    return _table(found, ("row", "positive_row", "negative_id", "negative_row", "negative_score"))


def _table(rows: list[tuple], names: tuple[str, ...]) -> pa.Table:
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.table([pa.array(c, pa.int64()) for c in columns], list(names))


def _met(anchors: DataFrame, buckets: DataFrame, lane: Column, find, schema: str) -> DataFrame:
    """``find`` for each block of anchors and shelf of buckets in one lane."""
    sizes = anchors.groupBy(lane.alias("lane")).agg(F.ceil(F.count(F.lit(1)) / ANCHORS).cast("int").alias("blocks"))
    shelves = buckets.groupBy(lane.alias("lane")).agg(F.ceil(F.count(F.lit(1)) / SHELF).cast("int").alias("shelves"))
    # One row for each lane.
    plan = stored(sizes.join(shelves, "lane"), "lanes")

    def dealt(n: str, key: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(n), key), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = anchors.withColumn("lane", lane).join(plan, "lane")
    left = left.withColumn("block", dealt("blocks", "row")).withColumn("shelf", every("shelves")).drop("blocks", "shelves")
    right = buckets.withColumn("lane", lane).join(plan, "lane")
    right = right.withColumn("shelf", dealt("shelves", "bucket")).withColumn("block", every("blocks")).drop("blocks", "shelves")
    keys = ["lane", "block", "shelf"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(find, schema)


def hard_negatives(vectors: DataFrame, is_anchor: Column) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` chooses the anchors by ``id``.
    """
    rows = usable(vectors)
    buckets = index(rows)
    anchors = stored(rows.where(is_anchor & (F.col("id") != NO_ID)).select("row", "id", "label", "vector"), "anchors")
    found = _met(anchors, buckets, F.col("label"), _find_positives, "row bigint, positive_id bigint, positive_row bigint, positive_score bigint")
    first = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    positives = found.withColumn("n", F.row_number().over(first)).where(F.col("n") <= POSITIVES).drop("n")
    lists = positives.groupBy("row").agg(F.collect_list(F.struct("positive_id", "positive_row", "positive_score")).alias("positives"))
    asked = stored(anchors.join(lists, "row"), "anchors-with-positives")
    schema = "row bigint, positive_row bigint, negative_id bigint, negative_row bigint, negative_score bigint"
    found = _met(asked, buckets, F.lit(0).cast("bigint"), _find_negatives, schema)
    first = Window.partitionBy("row", "positive_row").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    negatives = found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= NEGATIVES)
    pairs = asked.select("row", F.col("id").alias("anchor_id"), F.inline("positives"))

    def shown(c: str) -> Column:
        return F.when(F.col(c) != NO_ID, F.col(c)).alias(c)

    return negatives.join(pairs, ["row", "positive_row"]).select(
        "anchor_id", shown("positive_id"), "rank", shown("negative_id"), "positive_score", "negative_score"
    )


def of_every_hundredth(vectors: DataFrame) -> DataFrame:
    """Hard negatives of rows whose id is divisible by 100; every seventh id counts as of the next label."""
    mixed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = vectors.select("vec_id", "embedding", mixed.alias("label"))
    return hard_negatives(rows, F.col("id") % 100 == 0)


ORACLE_SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), ranked AS (
  SELECT p.anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS n
  FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  WHERE 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(n AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE n <= 10
"""
