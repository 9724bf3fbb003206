import math

import numpy as np
from pyspark.sql import functions as F

from trolley.llm import lemp


def brute(rows):
    """Rows of ids, vectors and labels, each a row of its own; a null id comes last in ties."""
    kept = []
    for vec_id, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, [math.floor(256 * float(v)) for v in x], label))
    late = 1 << 63
    out = []
    for a, (anchor, v, label) in enumerate(kept):
        if anchor is None or anchor % 100:
            continue
        scores = [(-sum(p * q for p, q in zip(v, w, strict=True)), late if i is None else i, k) for k, (i, w, _) in enumerate(kept)]
        for p, positive, _ in sorted(s for s in scores if s[2] != a and kept[s[2]][2] == label)[:5]:
            fit = sorted(s for s in scores if kept[s[2]][2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p)[:10]
            out += [(anchor, positive, r, n, -p, -s) for r, (s, n, _) in enumerate(fit, 1)]
    return sorted(tuple(None if x == late else x for x in r) for r in out)


def found_of(df):
    rows = df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    key = [tuple((v is None, v or 0) for v in r) for r in rows]
    return [tuple(r) for _, r in sorted(zip(key, rows, strict=True))]


def in_order(rows):
    return sorted(rows, key=lambda r: [(v is None, v or 0) for v in r])


def test_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in vectors.collect()]
    assert found_of(lemp.of_every_hundredth(vectors)) == in_order(brute(rows))


def test_odd_rows_ties_lengths_and_clashing_names(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(500):  # clusters of very different lengths, so that buckets and coordinates prune
        x = rng.normal(size=6) * 0.05
        x[i % 6] += 1
        rows.append((i, (x * (1 + i % 4) ** 2).tolist(), int(i // 2) % 4))
    rows += [(1000 + i, [1.0, 0, 0, 0, 0, 0], 2) for i in range(150)] + rows[:3] * 2
    rows += [(2000, None, 1), (2100, [1.0] * 6, None), (2200, [1.0, None, 1, 1, 1, 1], 1), (2300, [float("nan")] + [1.0] * 5, 1), (2400, [float("-inf")] + [1.0] * 5, 1), (2500, [0.0] * 6, 3), (None, [1.0, 0, 0, 0, 0, 0.0], 3), (2600, [-1.0, 0, 0, 0, 0, 0], 9)]
    rows = [(i, x and [None if v is None else float(v) for v in x], y) for i, x, y in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    df = df.withColumns({c: F.lit("?") for c in ("row", "id", "vector", "square", "lane", "block", "shelf", "rank", "positives")})
    want = in_order(brute(rows))
    assert len(want) > 100
    assert found_of(lemp.of_every_hundredth(df)) == want
    assert lemp.of_every_hundredth(df.limit(0)).count() == 0
    assert lemp.of_every_hundredth(df.where("vec_id = 100")).count() == 0
    other = df.unionByName(spark.createDataFrame([(3000, [1.0, 2.0], 1), (3100, [], 1)], "vec_id long, embedding array<double>, label int"), allowMissingColumns=True)
    assert found_of(lemp.of_every_hundredth(other)) == want


def test_candidates_hold_all_that_may_reach():
    rng = np.random.default_rng(9)
    matrix = rng.integers(-300, 300, (400, 8)) // rng.integers(1, 60, (400, 1))
    part = lemp.pa.table({"label": [1] * 400, "row": range(400), "id": range(400), "vector": matrix.tolist()})
    bucket = lemp.Bucket(lemp._bucket(part).to_pylist()[0])
    pruned = 0
    for q in rng.integers(-300, 300, (40, 8)):
        length = np.sqrt((q * q).sum())
        focus = np.argsort(-np.abs(q))[:3]
        for least in (0.2, 0.6, 0.9, 0.97):
            places = set(bucket.candidates(q / length, focus, least).tolist())
            size = np.sqrt((matrix * matrix).sum(1))
            true = np.flatnonzero(matrix @ q >= least * length * np.maximum(size, 1e-9))
            assert set(true[size[true] > 0].tolist()) <= places
            pruned += len(places) < 400
    assert pruned > 80


def test_numbers_beyond_doubles_stay_exact(spark):
    rows = [(0, [2.0**21 + 1 / 256, 3.0], 1), (1, [2.0**21 + 3 / 256, 5.0], 1), (2, [2.0**20 + 5 / 256, 7.0], 2), (3, [2.0**20 + 4 / 256, 7.0], 2)]
    df = spark.createDataFrame([(i, x, None if i == 0 else y) for i, x, y in rows], "vec_id long, embedding array<double>, label int")
    df = df.withColumn("label", F.when(F.col("vec_id") == 0, 0).otherwise(F.col("label")))  # 0 becomes label 1
    assert found_of(lemp.of_every_hundredth(df)) == in_order(brute([(0, rows[0][1], 0), *rows[1:]]))
