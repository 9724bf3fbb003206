import random

import numpy as np
from pyspark.sql import functions as F

from trolley.functions.ordered import dense_index, running_totals
from trolley.functions import quantiles
from trolley.functions.quantiles import exact_percentiles, exact_quantiles
from trolley.operators.metrics import binary_metrics


def test_dense_index_is_contiguous_in_key_order(spark):
    names = [f"n{i:05d}" for i in range(3000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names + names[:500] + [None]], "k string").repartition(7)
    found = {r.k: r.i for r in dense_index(df, "k", "i").collect()}
    assert found == {n: i for i, n in enumerate(sorted(names))}
    assert {r.i for r in dense_index(df, "k", "i", start=1).collect()} == set(range(1, 3001))


def test_running_totals_equal_a_sorted_walk(spark):
    df = spark.range(2000).select(
        ((F.col("id") * 7919) % 2003).alias("o"), (F.col("id") % 5).alias("a"), F.lit(1).alias("b")
    )
    rows = sorted(df.collect(), key=lambda r: r.o)
    found = {r.o: (r.a_before, r.b_before) for r in running_totals(df, "o", ["a", "b"], "t").collect()}
    a = 0
    for place, row in enumerate(rows):
        assert found[row.o] == (a, place)
        a += row.a


def test_exact_quantiles_of_mixed_columns(spark):
    rng = np.random.default_rng(5)
    n = 20000
    columns = {
        "normal": rng.normal(size=n),
        "heavy": np.where(rng.random(n) < 0.4, 3.0, rng.integers(0, 9, n)),
        "steps": np.repeat([1.0, 2.0], n // 2),
        "wide": np.exp(rng.normal(size=n) * 20),
    }
    rows = list(zip(*[c.tolist() for c in columns.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    df = df.withColumn("none", F.lit(None).cast("double"))
    for p in (0.5, 0.013, 1.0):
        expected = {c: float(np.sort(v)[int(np.ceil(n * p)) - 1]) for c, v in columns.items()}
        found = exact_quantiles(df, [*columns, "none"], p)
        assert found.pop("none") is None
        assert found == expected


def test_quantiles_are_elements_of_their_type(spark):
    import decimal

    big = 1 << 60
    rows = [(big + v, decimal.Decimal(v) / 100, v, f"s{v}") for v in (1, 3, 5)]
    df = spark.createDataFrame(rows, "a bigint, b decimal(20,2), c int, d string")
    assert exact_quantiles(df, ["a", "b", "c", "d"]) == {"a": big + 3, "b": decimal.Decimal("0.03"), "c": 3, "d": "s3"}
    assert exact_quantiles(df.limit(0), ["a", "c"]) == {"a": None, "c": None}


def test_area_under_curve_with_ties(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(20) / 20, int(rng.random() < 0.3)) for _ in range(500)]
    found = binary_metrics(spark.createDataFrame(rows, "score double, label int")).first()
    pos = [s for s, l in rows if l]
    neg = [s for s, l in rows if not l]
    pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(found.auc - pairs / len(pos) / len(neg)) < 1e-12
    assert found.accuracy == sum((s > 0.5) == bool(l) for s, l in rows) / len(rows)
    only = binary_metrics(spark.createDataFrame([(0.2, 1)], "score double, label int")).first()
    assert only.auc is None and only.precision is None and only.recall == 0.0


def test_percentiles_of_numbers_of_every_size(spark):
    rng = np.random.default_rng(11)
    n = 6000
    columns = {
        "spread": np.ldexp(rng.choice([-1.0, 1.0], n) * (1 + rng.random(n)), rng.integers(-1080, 1000, n)),
        "close": 1 + rng.integers(0, 50, n) * 2.0**-52,
        "odd": np.where(rng.random(n) < 0.3, rng.choice([np.inf, -np.inf, np.nan, 0.0, -0.0, 5e-324, 1.7e308], n), rng.normal(size=n)),
        "halves": np.ldexp(1.0, -rng.integers(0, 1074, n)),
    }
    whole = rng.integers(-(1 << 63), (1 << 63) - 1, n)
    whole[:3] = -(1 << 63), (1 << 63) - 1, 0
    near = (1 << 60) + rng.integers(0, 40, n)
    rows = list(zip(*[c.tolist() for c in columns.values()], whole.tolist(), near.tolist(), strict=True))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns) + ", whole long, near long").repartition(6)
    df = df.withColumn("money", F.expr("cast(near as decimal(38,2)) / 100").cast("decimal(38,4)"))
    shares = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99, 1.0, 0.0)
    found = exact_percentiles(df, [*columns, "whole", "near", "money"], shares)
    ranks = [max(1, int(np.ceil(round(n * s, 6)))) - 1 for s in shares]
    for name, values in [*columns.items(), ("whole", whole), ("near", near)]:
        want = np.sort(values)[ranks].tolist()
        assert all(a == b or (a != a and b != b) for a, b in zip(found[name], want, strict=True)), name
    assert [int(x * 100) for x in found["money"]] == np.sort(near)[ranks].tolist()
    assert exact_percentiles(df.limit(0), ["odd", "whole"], [0.5]) == {"odd": [None], "whole": [None]}


def test_no_value_is_shuffled(spark):
    df = spark.range(200_000).selectExpr("id * 7919 % 200000 / 3.0D as x")
    slots = {0: quantiles._Slot("x", 0, {0: 0})}
    bins = quantiles._scan(df, slots, {"x": "double"})
    assert len(bins[0]) < 200 and sum(n for n, *_ in bins[0]) == 200_000
