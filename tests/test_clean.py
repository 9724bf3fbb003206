from pyspark.sql import functions as F

from trolley.functions.keys import pad_id
from trolley.operators import clean

LOG = "customer_id string, article_id string, t_dat string, price double, sales_channel_id bigint"


def test_lowest_good_price_survives(spark):
    rows = [
        ("A ", "1", "2020-01-01", -1.0, 1),
        ("a", "1", "2020-01-01", 7.0, 1),
        ("a", "1", "2020-01-01", 5.0, 2),
        ("a", "1", "2020-01-01", 5.0, 1),
        (None, "1", "2020-01-01", 5.0, 1),
        ("b", None, "2020-01-01", 5.0, 1),
        ("b", "2", "not a date", None, 1),
        ("c", "2", "not a date", 3.0, 1),
    ]
    kept = clean.clean_transactions(spark.createDataFrame(rows, LOG)).orderBy("customer_id").collect()
    assert [(r.customer_id, r.article_id, r.price, r.sales_channel_id) for r in kept] == [
        ("a", "0000000001", 5.0, 1),
        ("c", "0000000002", 3.0, 1),
    ]
    assert kept[1].t_dat is None and kept[0].event_timestamp == kept[0].t_dat


def test_strings_are_trimmed_of_spaces_only(spark):
    df = spark.createDataFrame([("  Red ",), ("",), (None,), ("\tRed",)], "c string")
    out = clean.impute_constant(clean.normalize_strings(df))
    assert [r.c for r in out.collect()] == ["red", "", "unknown", "\tred"]


def test_named_constants_differ_from_the_rest(spark):
    df = spark.createDataFrame([(None, None)], "a string, b string")
    assert tuple(clean.impute_constant(df, {"a": "UNKNOWN"}).first()) == ("UNKNOWN", "unknown")


def test_ids_are_padded_not_cut(spark):
    df = spark.createDataFrame([("12",), ("123456789012",), (None,), ("x",)], "i string")
    padded = [r[0] for r in df.select(pad_id("i")).collect()]
    assert padded == ["0000000012", "123456789012", None, "000000000x"]


def test_median_is_the_lower_element_and_all_null_stays_null(spark):
    rows = [(1, 1.0, None), (2, 2.0, None), (4, 4.0, None), (9, 9.0, None), (None, None, None)]
    df = spark.createDataFrame(rows, "a bigint, b double, c double")
    last = clean.impute_median(df, ["a", "b", "c"]).where(F.col("a") == 2).collect()
    assert len(last) == 2
    assert {tuple(r) for r in last} == {(2, 2.0, None)}
    assert dict(clean.impute_median(df, ["a"]).dtypes)["a"] == "bigint"


def test_item_keys_are_not_filled(spark):
    df = spark.createDataFrame([(1, 7, 3), (2, None, None)], "article_id bigint, product_code bigint, section_no bigint")
    out = clean.clean_articles(df).orderBy("article_id").collect()
    assert [(r.article_id, r.product_code, r.section_no) for r in out] == [
        ("0000000001", 7, 3),
        ("0000000002", None, 3),
    ]


def test_empty_input_is_refused(spark):
    full = spark.createDataFrame([("a", "1", "2020-01-01", 1.0, 1)], LOG)
    empty = full.limit(0)
    try:
        clean.preprocess(full, full, empty)
    except ValueError as error:
        assert "transactions" in str(error)
    else:
        raise AssertionError("empty transactions accepted")


def test_latest_vector_wins(spark):
    rows = [("a", 1.0, 1), ("a", 2.0, 3), ("a", 9.0, 2), ("b", 5.0, 1)]
    df = spark.createDataFrame(rows, "k string, v double, t int")
    assert sorted(tuple(r) for r in clean.dedup_latest(df, "k", "t").collect()) == [
        ("a", 2.0, 3),
        ("b", 5.0, 1),
    ]
