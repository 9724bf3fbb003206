import collections
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from trolley.llm import hilbert, mixing


def found_of(df):
    out = collections.defaultdict(list)
    for r in df.collect():
        out[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    return {q: [x[1:] for x in sorted(rows)] for q, rows in out.items()}


def brute(ids, x, k=20):
    out = {}
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        out[int(ids[i])] = [int(ids[j]) for j in np.lexsort((ids, -scores))[: min(k, len(ids) - 1)]]
    return out


def test_recall_of_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = found_of(hilbert.every_twentieth(vectors))
    rows = vectors.orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    true = brute(ids, x)
    assert found.keys() == true.keys() and all(len(f) == 20 for f in found.values())
    hits = sum(len({v for v, _ in found[q]} & set(true[q])) for q in true)
    assert hits / sum(map(len, true.values())) >= 0.9
    place = {int(v): i for i, v in enumerate(ids)}
    assert all(abs(x[place[q]] @ x[place[v]] - s) < 1e-12 for q, f in found.items() for v, s in f)
    assert all(f == sorted(f, key=lambda y: (-y[1], y[0])) for f in found.values())


def test_odd_vectors_copies_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), (rng.normal(size=6) * (1 + i % 3)).tolist()) for i in range(30)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(200)]
    odd = [(1001, None), (1002, []), (1003, [0.0] * 6), (1004, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1005, [float("nan")] + [1.0] * 5), (1006, [float("inf")] + [1.0] * 5), (1007, [1.0]), (1020, None), (None, [1.0] * 6)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    df = df.withColumns({c: F.lit("?") for c in ("point", "curve", "place", "block", "query", "score", "rank")})
    found = found_of(hilbert.every_twentieth(df))
    true = brute(np.array([r[0] for r in rows]), np.array([r[1] for r in rows]))
    assert found.keys() == true.keys()
    assert {q: [v for v, _ in f] for q, f in found.items()} == true
    few = found_of(hilbert.every_twentieth(df.where("vec_id < 5")))
    assert {q: len(f) for q, f in few.items()} == {0: 4}
    assert hilbert.every_twentieth(df.limit(0)).count() == 0
    assert hilbert.every_twentieth(df.where("vec_id > 1000")).where("query_id = 1020").count() == 0


def test_hilbert_neighbours_touch():
    for bits, dimensions in ((3, 2), (2, 3), (2, 4)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        order = np.argsort(hilbert.hilbert_numbers(grid, bits))
        assert len(set(hilbert.hilbert_numbers(grid, bits).tolist())) == len(grid)
        assert (np.abs(np.diff(grid[order].astype(int), axis=0)).sum(1) == 1).all()


def mix_rows():
    random.seed(8)
    rows = []
    for i in range(900):
        source = "big" if i % 3 else random.choice(["a", "b", "c", "d", None])
        rows.append((i, "w " * random.randrange(60), source))
    return [*rows, (2000, None, "a"), (2001, "", "void"), (None, "x y", "b"), (7, "again", "c"), (7, "again", "c"), (3000, "long " * 100_000, "big")]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mix_equals_sql(spark):
    rows = mix_rows()
    out = sorted(map(tuple, mixing.mixed_report(frame(spark, rows)).collect()), key=str)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    assert out == sorted(con.execute(mixing.ORACLE_SQL).fetchall(), key=str)


def test_mix_reaches_its_weights(spark):
    rows = mix_rows()
    df = frame(spark, rows).withColumns({c: F.lit("?") for c in ("group", "tokens", "block", "mix", "full", "row", "weight")})
    assert mixing.mix(df).columns == df.columns
    out = mixing.copies(df).select("row.doc_id", "row.source", "row.text", "weight")
    taken = out.groupBy("source").agg(F.sum(mixing.tokens("text")).alias("n"), F.max("weight").alias("w")).collect()
    total = sum(r["n"] for r in taken)
    longest = max(len((t or "").split()) for _, t, _ in rows if t and not t.startswith("long"))
    assert all(abs(r["n"] - r["w"] * total) <= 2 * longest + 2 for r in taken)
    copies = collections.Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert {r[0] for r in rows} == set(copies)
    shares = np.array([r["w"] for r in taken if r["n"]])
    natural = collections.Counter()
    for _, text, source in rows:
        natural[source] += len((text or "").split())
    p = np.array([n / sum(natural.values()) for n in natural.values() if n])
    entropy = lambda v: -(v * np.log(v)).sum()
    assert entropy(shares) > entropy(p) and max(c for i, c in copies.items() if i != 7) <= mixing.REPEATS


def test_budget_is_kept(spark):
    rows = [(i, "w " * 10, "a" if i % 4 else "b") for i in range(2000)]
    out = mixing.mix(frame(spark, rows), entropy=1.0, repeats=1.5, budget=10_000.0)
    taken = {r["source"]: r["count"] * 10 for r in out.groupBy("source").count().collect()}
    assert all(4990 <= n <= 5000 for n in taken.values())
    limited = mixing.mix(frame(spark, rows), entropy=1.0, repeats=1.5, budget=20_000.0)
    taken = {r["source"]: r["count"] * 10 for r in limited.groupBy("source").count().collect()}
    assert 7480 <= taken["b"] <= 7500 and 12_480 <= taken["a"] <= 12_510


def test_mix_of_little(spark):
    assert mixing.mixed_report(frame(spark, [])).count() == 0
    assert mixing.mixed_report(frame(spark, [(1, None, None), (2, "", "x")])).count() == 2
    one = mixing.mixed_report(frame(spark, [(1, "a b", "x")])).collect()
    assert [(r["weight"], r["epoch"]) for r in one] == [(1.0, 0)]
