from pyspark.sql import functions as F

from trolley.operators import joins


def facts(spark):
    """A third of the rows on one key, many with a null key, some keys without a match."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 9 == 1, F.lit(None))
        .otherwise(F.col("id") % 50)
        .cast("bigint")
        .alias("k"),
        (F.col("id") % 10).alias("v"),
    )
    return rows.repartition(6)


def table(spark):
    return spark.range(45).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))


def counted(df):
    return sorted((tuple(str(x) for x in r) for r in df.groupBy(*df.columns).count().collect()))


def test_joins_match_null_keys_where_asked(spark):
    nulls = spark.createDataFrame([(None, 5), (7, 6)], "k bigint, w bigint")
    out = joins.skew_join(facts(spark), nulls, "k", "inner", null_keys=True)
    assert out.columns == ["k", "v", "w"]
    assert {r.k: r.w for r in out.distinct().collect()} == {None: 5, 7: 6}
    assert joins.skew_join(facts(spark), nulls, "k", "inner").where("k IS NULL").count() == 0


def test_a_hot_key_is_cut_to_parts(spark):
    """With thresholds below the test's size the one plan shows the cut partition."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {k: spark.conf.get(k) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        out = joins.skew_join(facts(spark).withColumn("x", F.md5(F.rand(1).cast("string"))), table(spark), "k")
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in plan
    plain = facts(spark).join(table(spark), "k", "left")
    assert counted(out.drop("x")) == counted(plain) and len(rows) == 9000
