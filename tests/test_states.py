import math
import random

from pyspark.sql import functions as F

from trolley.operators import split
from trolley.sources import sinks
from trolley.streaming import states

SHAPE = "a double, b long, s string, none int"


def rows(seed, n):
    chosen = random.Random(seed)
    gap = lambda x: None if chosen.random() < 0.1 else x
    return [(gap(chosen.gauss(1e6, 3)), gap(chosen.randrange(50)), gap(f"s{chosen.randrange(900)}"), None) for _ in range(n)]


def found_of(df):
    return {r.feature: r.asDict() for r in states.merged_statistics(df).collect()}


def test_merged_states_equal_one_pass(spark):
    parts = [spark.createDataFrame(rows(k, n), SHAPE) for k, n in enumerate((700, 1, 2500, 40))]
    parts.append(spark.createDataFrame([], SHAPE))
    parts.append(spark.createDataFrame([(None, None, None, None)] * 3, SHAPE))
    merged = states.chunk_states(parts[0])
    whole = parts[0]
    for part in parts[1:]:
        merged, whole = merged.unionByName(states.chunk_states(part)), whole.unionByName(part)
    found, data = found_of(merged), whole.collect()
    for c in ("a", "b"):
        values = sorted(r[c] for r in data if r[c] is not None)
        mean = sum(values) / len(values)
        std = math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1))
        f = found[c]
        assert (f["count"], f["null_count"], f["min"], f["max"]) == (len(values), len(data) - len(values), values[0], values[-1])
        assert math.isclose(f["mean"], mean, rel_tol=1e-12) and math.isclose(f["std"], std, rel_tol=1e-6)
        for name, p in (("p01", 0.01), ("p50", 0.5), ("p99", 0.99)):
            below, upto = sum(v < f[name] for v in values), sum(v <= f[name] for v in values)
            assert below / len(values) <= p + states.RANK_ERROR and upto / len(values) >= p - states.RANK_ERROR
    texts = {r.s for r in data if r.s is not None}
    assert abs(found["s"]["unique_count"] - len(texts)) <= states.DISTINCT_ERROR * len(texts)
    assert found["s"]["p50"] is None and found["s"]["mean"] is None
    assert found["none"]["count"] == 0 and found["none"]["max"] is None and found["none"]["unique_count"] == 0


def test_a_new_chunk_reads_no_old_one(spark, tmp_path):
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.createDataFrame(rows(1, 300), SHAPE).coalesce(1).write.parquet(inbox)
    schema = spark.read.parquet(inbox).schema
    states.update_states(spark, inbox, schema, out, progress, 1)
    old = next((tmp_path / "in").glob("*.parquet"))
    spark.createDataFrame(rows(2, 200), SHAPE).coalesce(1).write.mode("append").parquet(inbox)
    old.write_bytes(b"not a table any more")
    found = found_of(states.update_states(spark, inbox, schema, out, progress, 1))
    both = spark.createDataFrame(rows(1, 300) + rows(2, 200), SHAPE)
    want = found_of(states.chunk_states(both))
    assert {c: (f["count"], f["null_count"], f["min"], f["max"]) for c, f in found.items()} == {
        c: (f["count"], f["null_count"], f["min"], f["max"]) for c, f in want.items()
    }


def test_counts_come_from_the_write(spark, tmp_path):
    parts = spark.range(50).select("id", F.when(F.col("id") < 30, "train").when(F.col("id") < 33, "test").alias("split"))
    path = str(tmp_path / "parts")
    row = sinks.write_split(parts.repartition(7), path, "prod", 512, 7).first()
    assert tuple(row) == ("prod", 30, 0, 3, 512, 7)
    assert spark.read.parquet(path).count() == 50
    shape = sinks.write_counted(parts.where("id < 0"), str(tmp_path / "none"), "none").first()
    assert tuple(shape) == ("none", 0, 2)
    assert sinks.write_table(parts, str(tmp_path / "plain")) == {}
    assert split.SPLITS == ("train", "validation", "test")
