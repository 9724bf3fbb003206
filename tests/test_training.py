import datetime as dt

from pyspark.sql import functions as F

from trolley.operators import encoding, training

LOG = "customer_id string, article_id string, t_dat timestamp_ntz, purchase_count bigint, avg_spend double, item_purchase_count bigint, unique_buyers bigint, avg_item_price double"
DAY = dt.datetime(2020, 1, 1)


def log(spark):
    rows = [(f"u{u}", f"{i}", DAY, 5, 2.0, 1, 1, 3.0) for u in range(40) for i in range(u % 7 + 1)]
    return spark.createDataFrame(rows, LOG)


def index(spark, size):
    rows = [(f"{i:010d}", i) for i in range(size)]
    return spark.createDataFrame(rows, "article_id string, article_idx bigint")


def test_negatives_avoid_positives_and_are_stable(spark):
    df = log(spark)
    first = training.negative_samples(df.repartition(2), index(spark, 25))
    second = training.negative_samples(df.repartition(9), index(spark, 25))
    assert first.exceptAll(second).isEmpty() and second.exceptAll(first).isEmpty()
    positives = df.select("customer_id", F.lpad("article_id", 10, "0").alias("article_id"))
    assert first.join(positives, ["customer_id", "article_id"], "left_semi").isEmpty()
    drawn = 3 * df.count()
    kept = first.count()
    assert 0.7 * drawn < kept < drawn
    assert first.select("article_id").distinct().count() > 20


def test_a_user_who_bought_everything_has_no_negatives(spark):
    rows = [("u", str(i), DAY, 1, 1.0, 1, 1, 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, LOG)
    assert training.negative_samples(df, index(spark, 4)).isEmpty()


def test_ranking_rows_hold_vectors_and_features(spark):
    items = spark.createDataFrame(
        [(f"{i:010d}", 1, 1, 3.0) for i in range(30)],
        "article_id string, item_purchase_count bigint, unique_buyers bigint, avg_item_price double",
    )
    vectors = spark.createDataFrame(
        [(str(i), [float(i), 1.0], DAY) for i in range(0, 30, 2)],
        "article_id string, image_embedding array<float>, event_timestamp timestamp_ntz",
    )
    rows = training.ranking_dataset(log(spark), items, vectors).cache()
    assert rows.where("label = 1").count() == log(spark).where("article_id % 2 = 0").count()
    assert rows.where("label = 0").count() > 0
    assert rows.where("image_embedding is null or purchase_count is null").isEmpty()
    assert rows.where("cast(article_id as int) % 2 = 1").isEmpty()
    balance = {r.label: r.share for r in training.label_balance(rows).collect()}
    assert abs(sum(balance.values()) - 1) < 1e-12


def test_unknown_categories_become_zero(spark):
    known = encoding.vocabulary(spark.createDataFrame([("b",), ("a",), (None,)], "c string"), "c")
    assert {r.c: r.c_idx for r in known.collect()} == {"a": 1, "b": 2}
    asked = spark.createDataFrame([("b",), ("z",), (None,)], "c string")
    found = {r.c: r.c_idx for r in encoding.encode_categories(asked, {"c": known}).collect()}
    assert found == {"b": 2, "z": 0, None: 0}


def test_matrices_fill_gaps(spark):
    users = spark.createDataFrame([("u", 1, None)], "customer_id string, a int, b double")
    row = encoding.encode_user_matrix(users, ["a", "b"]).first()
    assert (row.a, row.b) == (1.0, 0.0)
    items = spark.createDataFrame([("i", None, None)], "article_id string, a int, c bigint")
    row = encoding.encode_item_matrix(items, ["a"], ["c"]).first()
    assert (row.a, row.c) == (0.0, -1)


def catalogue(spark):
    items = spark.createDataFrame(
        [(f"{i:010d}", 1, None if i % 5 else 2, 3.0) for i in range(30)],
        "article_id string, item_purchase_count bigint, unique_buyers bigint, avg_item_price double",
    )
    vectors = spark.createDataFrame(
        [(str(i), [float(i), 1.0], DAY) for i in range(0, 40, 2)],
        "article_id string, image_embedding array<float>, event_timestamp timestamp_ntz",
    )
    return items, vectors


def test_stored_draws_give_the_same_rows(spark):
    odd = spark.createDataFrame([(None, "2", DAY, 1, 1.0, 1, 1, 1.0), ("u9", None, DAY, 1, 1.0, 1, 1, 1.0), ("u9", "32", DAY, 1, 1.0, 1, 1, 1.0)], LOG)
    df = log(spark).unionByName(odd)
    first = training.ranking_dataset(df, *catalogue(spark))
    second = training.ranking_dataset(df, *catalogue(spark), stored=True)
    assert sorted(map(tuple, second.collect()), key=str) == sorted(map(tuple, first.collect()), key=str)


def test_rows_of_an_item_follow_each_other(spark):
    """So that its vector is in a file about once, also where the vectors could be broadcast."""
    rows = training.ranking_dataset(log(spark), *catalogue(spark), stored=True)
    placed = rows.select("article_id", F.spark_partition_id().alias("p")).collect()
    runs = sum(a != b for a, b in zip(placed[1:], placed))
    assert len(placed) > 300 and runs <= 2 * len({r.article_id for r in placed})


def test_draws_are_shuffled_twice_and_no_earlier_shuffle_is_left(spark):
    made, write = [], training.materialize

    def kept(df, name, *rest):
        made.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return write(df, name, *rest)

    training.materialize = kept
    try:
        rows = training.ranking_dataset(log(spark), *catalogue(spark), stored=True)
    finally:
        training.materialize = write
    drawn = dict(made)["draws"]
    assert "LeftAnti" in drawn and "explode" in drawn
    final = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in final and final.count("Join Inner") == 3  # positives and vectors, draws and items, items and vectors
