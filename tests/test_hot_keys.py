"""The final plans of the fact joins on a log of which one user and one item hold most rows."""

import contextlib

import pytest
from pyspark.sql import functions as F

from testbed import queries as q
from trolley.operators import encoding, interactions, training, users

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
}
ROWS = 30_000


@contextlib.contextmanager
def low_thresholds(spark):
    before = {k: spark.conf.get(k) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def log(spark):
    """80 % of the rows of one user, 80 % of one item."""
    number = F.col("id")
    return spark.range(ROWS).repartition(6).select(
        F.concat(F.lit("u"), F.when(number % 5 > 0, 0).otherwise(number % 300)).alias("customer_id"),
        F.lpad(F.when(number % 25 < 20, 0).otherwise(number % 200).cast("string"), 10, "0").alias("article_id"),
        F.timestamp_seconds(number * 4000).cast("timestamp_ntz").alias("t_dat"),
        (number % 100 + 1).cast("double").alias("price"),
        (number % 2 + 1).alias("sales_channel_id"),
        F.timestamp_seconds(number * 4000).cast("timestamp_ntz").alias("event_timestamp"),
        F.md5(number.cast("string")).alias("note"),
    )


def customers(spark):
    return spark.range(300).select(F.concat(F.lit("u"), "id").alias("customer_id"), F.col("id").alias("age"))


def articles(spark):
    return spark.range(200).select(
        F.lpad(F.col("id").cast("string"), 10, "0").alias("article_id"),
        (F.col("id") % 7).cast("string").alias("product_group_name"),
        (F.col("id") % 5).cast("string").alias("colour_group_name"),
        *[(F.col("id") % 9).alias(c) for c in training.ITEM_CODES],
    )


def vectors(spark):
    return articles(spark).select(
        "article_id",
        F.array(F.lit(1.0), F.lit(2.0)).cast("array<float>").alias("image_embedding"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("event_timestamp"),
    )


def two_tower(spark):
    return interactions.two_tower_interactions(log(spark), customers(spark), articles(spark))


def popularity(spark):
    return log(spark).groupBy("article_id").agg(
        F.count(F.lit(1)).alias("item_purchase_count"), F.count_distinct("customer_id").alias("unique_buyers"), F.avg("price").alias("avg_item_price")
    )


#: Each with the number of fact joins whose hot key has to be cut.
MADE = {
    "purchase_recency": (lambda s: users.purchase_recency(log(s)), 1),
    "ranking_interactions": (lambda s: interactions.ranking_interactions(log(s), customers(s), articles(s)), 2),
    "two_tower_interactions": (two_tower, 2),
    "ranking_dataset": (lambda s: training.ranking_dataset(two_tower(s), popularity(s), vectors(s)), 3),
    "two_tower_dataset": (lambda s: training.two_tower_dataset(log(s), encoding.user_index(log(s)), encoding.item_index(log(s)), vectors(s)), 2),
    "retrieval_dataset": (lambda s: training.retrieval_dataset(two_tower(s), vectors(s)), 3),
}


@pytest.mark.parametrize("name", MADE)
def test_hot_keys_are_cut(spark, name):
    made, joins = MADE[name]
    with low_thresholds(spark):
        df = made(spark)
        rows = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert rows >= ROWS * 0.99
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("skew=true") >= joins, final


def test_the_queries_are_made_of_these_operators():
    assert set(MADE) <= set(q.QUERIES)
