"""Nearest neighbours by inner product from several Hilbert orderings.

Vectors get one more component that makes their lengths equal (so that the largest inner product is
the nearest point), are projected to ``DIMENSIONS`` by orthonormal axes, shifted, cut to ``BITS`` bits
a dimension, and numbered along a Hilbert curve; each of the ``CURVES`` orderings has its own axes and
shift. Spark range-partitions every ordering, and a vector's place is its rank in it. A query's
candidates are the vectors at most ``reach`` places away in any ordering; they are ranked by inner
products of the original vectors in double precision.

``reach`` is fitted, not fixed: for about ``SAMPLE`` queries the true neighbours are found by brute
force (the sample against all rows, in blocks), and it is the smallest distance in places, over the
orderings, that the wanted share ``RECALL`` of them keeps. Clustered data need a short reach; data
without structure need a long one, as no ordering can help there.

Equal vectors are one point: the ``K + 1`` smallest ids stand for it, which is all that a list of
``K`` with ties to smaller ids can use. Rows: queries get up to ``K`` rows. Null and zero vectors, and
those with null or non-finite components or of another length than most, take no part. Repeated ids count as rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.llm.common import stored

K = 20
CURVES, DIMENSIONS, BITS = 4, 8, 7
SAMPLE = 64
RECALL = 0.95
#: Places of an ordering that are compared together; a query looks at the blocks its reach touches.
BLOCK = 16_384
#: Rows a block of queries is cut to.
QUERY_BLOCK = 512
SALTS = 16


def hilbert_numbers(grid: np.ndarray, bits: int) -> np.ndarray:
    """Places of grid points (rows of unsigned numbers below ``2 ** bits``) on a Hilbert curve.

    Gray-code construction: bits are undone from the highest down, then interleaved.
    """
    x = grid.T.astype(np.uint64).copy()
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = np.uint64(1 << level), np.uint64((1 << level) - 1)
        for row in x:
            set_bit = (row & bit) != 0
            swap = np.where(set_bit, np.uint64(0), (x[0] ^ row) & low)
            x[0] = np.where(set_bit, x[0] ^ low, x[0] ^ swap)
            if row is not x[0]:
                row ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[-1] & np.uint64(1 << level), turn ^ np.uint64((1 << level) - 1), turn)
    x ^= turn
    out = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for row in x:
            out = (out << one) | ((row >> np.uint64(level)) & one)
    return out.view(np.int64)


class Curves:
    """Axes, shifts and scale of the orderings, from the vectors' common length."""

    def __init__(self, size: int, longest: float) -> None:
        draws = np.random.default_rng(4_211)
        self.longest = longest
        self.axes = [np.linalg.qr(draws.normal(size=(size + 1, size + 1)))[0][:, : min(DIMENSIONS, size + 1)] for _ in range(CURVES)]
        self.shifts = draws.random((CURVES, min(DIMENSIONS, size + 1)))
        self.spread = 3.0 / np.sqrt(size + 1)

    def numbers(self, x: np.ndarray) -> list[np.ndarray]:
        unit = x / self.longest
        rest = np.sqrt(np.maximum(0, 1 - np.square(unit).sum(1)))
        lifted = np.hstack([unit, rest[:, None]])
        out = []
        for axes, shift in zip(self.axes, self.shifts, strict=True):
            cell = (lifted @ axes / self.spread + 1) / 2 * 0.75 + shift * 0.25
            grid = np.clip(cell * (1 << BITS), 0, (1 << BITS) - 1).astype(np.uint64)
            out.append(hilbert_numbers(grid, BITS))
        return out


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of doubles from lists of equal length."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, size)


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, embedding`` (doubles) of the rows that take part."""
    e = F.col("embedding")
    odd = F.exists(e, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), e.cast("array<double>").alias("embedding"))
    return rows.where(e.isNotNull() & F.exists(e, lambda x: x != 0) & ~odd & F.col("vec_id").isNotNull())


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows of every row that ``is_query`` chooses."""
    rows = usable(vectors)
    lengths = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    if not lengths:
        return _none(rows)
    size = lengths[0]["n"]
    rows = rows.where(F.size("embedding") == size)
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    longest = rows.agg(F.sqrt(F.max(square)).alias("m")).first()["m"]
    points = _points(rows, is_query, k)
    placed = _placed(points, Curves(size, longest), size)
    total = placed.where("curve = 0").count()
    reach = _fitted_reach(placed, points, size, total, k)
    found = _ranked(placed, reach, size, k)
    return _expanded(found, rows.where(is_query), points, k)


def _none(rows: DataFrame) -> DataFrame:
    return rows.limit(0).select(
        F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score")
    )


def _points(rows: DataFrame, is_query, k: int) -> DataFrame:
    """Different vectors: ``point, embedding, ids`` (the smallest ones) and ``asked`` (has queries)."""
    point = F.xxhash64("embedding")
    first = Window.partitionBy("point").orderBy("vec_id")
    # A point of very many copies keeps k + 1 of each task's rows before they are shuffled.
    ids = rows.select(point.alias("point"), "vec_id").withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
    ids = ids.groupBy("point").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    kinds = rows.select(point.alias("point"), is_query.cast("int").alias("asked"), "embedding")
    kinds = kinds.groupBy("point").agg(F.max("asked").alias("asked"), F.first("embedding").alias("embedding"))
    return stored(kinds.join(ids, "point"), "points")


def _placed(points: DataFrame, curves: Curves, size: int) -> DataFrame:
    """``curve, place, point, asked, embedding``: every point's rank in every ordering."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for curve, n in enumerate(curves.numbers(_matrix(batch.column(2), size))):
                kind = pa.array(np.full(len(n), curve, np.int32))
                yield pa.RecordBatch.from_arrays([kind, pa.array(n), *batch.columns], ["curve", "number", "point", "asked", "embedding"])

    schema = "curve int, number bigint, point bigint, asked int, embedding array<double>"
    ordered = points.select("point", "asked", "embedding").mapInArrow(number, schema)
    ordered = ordered.repartitionByRange("curve", "number", "point").sortWithinPartitions("curve", "number", "point")
    kept = stored(ordered.withColumn("at", F.monotonically_increasing_id()), "orderings")
    kept = kept.withColumn("part", F.shiftright("at", 33))
    inside = Window.partitionBy("part", "curve").orderBy("at")
    sizes = kept.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range and ordering.
    starts = sizes.select("curve", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = kept.withColumn("inside", F.row_number().over(inside) - 1).join(starts, ["curve", "part"])
    return stored(
        placed.select("curve", (F.col("start") + F.col("inside")).alias("place"), "point", "asked", "embedding"), "places"
    )


def _fitted_reach(placed: DataFrame, points: DataFrame, size: int, total: int, k: int) -> int:
    """Places within which the sample's true neighbours are found."""
    asked = points.where("asked = 1")
    share = SAMPLE / max(asked.count(), 1)
    limit = min(1 << 30, int(share * (1 << 30)))
    drawn = asked.where(F.pmod(F.xxhash64(F.lit("reach"), "point"), F.lit(1 << 30)) < limit)
    drawn = drawn.orderBy("point").limit(4 * SAMPLE).select("point", "embedding").toArrow()
    if not drawn.num_rows:
        return 1
    queries = _matrix(drawn["embedding"].combine_chunks(), size)
    names = drawn["point"].to_numpy()

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0), np.zeros(0, np.int64))] * len(names)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column(0).to_numpy()
            scores = queries @ _matrix(batch.column(1), size).T
            scores[names[:, None] == own[None, :]] = -np.inf
            for q in range(len(names)):
                s, p = np.concatenate([top[q][0], scores[q]]), np.concatenate([top[q][1], own])
                order = np.lexsort((p, -s))[:k]
                top[q] = s[order], p[order]
        q = np.repeat(names, [len(t[0]) for t in top])
        columns = [pa.array(q, pa.int64()), pa.array(np.concatenate([t[1] for t in top]), pa.int64()), pa.array(np.concatenate([t[0] for t in top]))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "point", "score"])

    found = points.select("point", "embedding").mapInArrow(best, "query bigint, point bigint, score double")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "point")
    true = found.where(F.col("score") > float("-inf")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)
    at = placed.select("curve", "place", "point")
    near = true.join(at, "point").join(at.select("curve", F.col("place").alias("own"), F.col("point").alias("query")), ["query", "curve"])
    gaps = near.groupBy("query", "point").agg(F.min(F.abs(F.col("place") - F.col("own"))).alias("gap"))
    gaps = sorted(r["gap"] for r in gaps.select("gap").collect())  # at most 4 * SAMPLE * k numbers
    if not gaps:
        return 1
    return min(total, max(k, int(gaps[min(len(gaps) - 1, int(np.ceil(RECALL * len(gaps))) - 1)])))


def _ranked(placed: DataFrame, reach: int, size: int, k: int) -> DataFrame:
    """``query, found``: the best points of each asked point, ``found`` sorted by falling score."""
    block = F.floor(F.col("place") / BLOCK).cast("bigint")
    rows = placed.withColumn("block", block)
    sides = F.floor((F.col("place") - reach) / BLOCK), F.floor((F.col("place") + reach) / BLOCK)
    looked = rows.where("asked = 1").select("curve", F.explode(F.sequence(F.greatest(sides[0], F.lit(0)).cast("bigint"), sides[1].cast("bigint"))).alias("block"), "place", F.col("point").alias("query"), "embedding")
    # Queries of a block are cut to parts, so that no task has more than a block and a part.
    part = F.floor(F.pmod(F.col("place"), F.lit(BLOCK)) / QUERY_BLOCK).cast("bigint")
    queries = looked.groupBy("curve", "block", part.alias("part")).agg(F.collect_list(F.struct("query", "place", "embedding")).alias("q"))
    blocks = rows.groupBy("curve", "block").agg(F.sort_array(F.collect_list(F.struct("place", "point", "embedding"))).alias("b"))
    pairs = queries.join(blocks, ["curve", "block"]).select("q.query", F.col("q.place").alias("q_place"), F.col("q.embedding").alias("q_vector"), "b.place", "b.point", "b.embedding")
    pairs = pairs.toDF("query", "q_place", "q_vector", "place", "point", "vector")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (b.slice(i, 1) for b in batches for i in range(b.num_rows)):
            query, at, place, point = (row.column(c).flatten().to_numpy() for c in (0, 1, 3, 4))
            q, v = (_matrix(row.column(c).flatten(), size) for c in (2, 5))
            products = q @ v.T
            far = (np.abs(at[:, None] - place[None, :]) > reach) | (query[:, None] == point[None, :])
            products[far] = -np.inf
            n = min(k, len(point))
            top = np.argpartition(-products, n - 1, axis=1)[:, :n]
            least = np.take_along_axis(products, top, 1).min(1)
            # Products may differ from the returned scores in their last bits.
            slack = 1e-12 * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max()
            names, points, scores = [], [], []
            for i in range(len(query)):
                keep = np.flatnonzero((products[i] >= least[i] - slack[i]) & (products[i] > -np.inf))
                score = np.einsum("ij,j->i", v[keep], q[i])
                # All ties of the last one stay, so that ids can decide.
                last = np.partition(score, -n)[-n] if len(score) > n else -np.inf
                keep, score = keep[score >= last], score[score >= last]
                names.append(np.full(len(keep), query[i]))
                points.append(point[keep])
                scores.append(score)
            columns = [pa.array(np.concatenate(c)) for c in (names, points, scores)]
            yield pa.RecordBatch.from_arrays(columns, ["query", "point", "score"])

    found = pairs.mapInArrow(score, "query bigint, point bigint, score double").distinct()
    order = Window.partitionBy("query").orderBy(F.desc("score"))
    best = found.withColumn("n", F.rank().over(order)).where(F.col("n") <= k)
    return best.groupBy("query").agg(F.collect_list(F.struct("point", "score")).alias("found"))


def _expanded(found: DataFrame, queries: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Points to ids: a query's own point first brings its other copies."""
    ids = points.select("point", "ids")
    others = found.select("query", F.explode("found").alias("f")).select("query", "f.point", "f.score")
    square = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)
    own = points.where("asked = 1").select(F.col("point").alias("query"), "point", square.alias("score"))
    both = others.unionByName(own).join(ids, "point")
    rows = both.select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # One more than asked for: a query's own id is among them or not.
    rows = rows.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
    lists = rows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))).alias("list"))
    # A point may have very many queries: its list is copied to a fixed number of salts.
    salted = lists.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    asked = queries.select(F.xxhash64("embedding").alias("query"), F.col("vec_id").alias("query_id"))
    asked = asked.withColumn("salt", F.pmod(F.hash("query_id"), F.lit(SALTS)))
    mine = F.slice(F.filter("list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    out = asked.join(salted, ["query", "salt"]).select("query_id", F.posexplode(mine).alias("rank", "x"))
    return out.select("query_id", (F.col("rank") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.less")).alias("score"))


def every_twentieth(vectors: DataFrame) -> DataFrame:
    """The 20 nearest of rows whose id is divisible by 20."""
    return nearest(vectors, F.col("vec_id") % 20 == 0, K)
