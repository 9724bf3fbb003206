from trolley.operators import profile


def test_statistics_of_gaps_and_all_null(spark):
    rows = [(1, "a", [1.0, 2.0]), (2, "a", None), (3, None, [1.0]), (None, "b", [])]
    df = spark.createDataFrame(rows, "n int, s string, v array<float>")
    number = profile.numeric_statistics(df).first()
    assert (number["count"], number.null_count, number.min, number.max, number.mean, number.std) == (3, 1, 1.0, 3.0, 2.0, 1.0)
    assert number.p50 == 2.0
    words = {r.value: (r["count"], r["rank"], r.unique_count) for r in profile.categorical_statistics(df).collect()}
    assert words == {"a": (2, 1, 3), None: (1, 2, 3), "b": (1, 3, 3)}
    vector = profile.embedding_statistics(df).first()
    assert (vector["count"], vector.null_count, vector.avg_dimension) == (4, 1, 1.0)


def test_top_values_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("cast(id % 37 as string) as s")
    top = profile.top_values(df, k=3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    assert top.count() == 3


def test_null_shares(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    shares = {r.feature: r.null_share for r in profile.null_profile(df).collect()}
    assert shares == {"a": 0.5, "b": 1.0}
