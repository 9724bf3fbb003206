import numpy as np
import pytest

from trolley.operators import cold_items, joins, prepare


def test_fitted_on_one_table_and_applied_to_another(spark):
    train = spark.createDataFrame([(1.0, 5, None), (3.0, 5, None), (float("nan"), None, None), (float("inf"), 5, None)], "a double, b int, c double")
    other = spark.createDataFrame([(5.0, 7, 1.0), (None, None, None), (1.0, 5, 2.0), (float("nan"), 5, 2.0)], "a double, b int, c double")
    ranges = prepare.fit_ranges(train, ["a", "b", "c"])
    assert ranges == {"a": (1.0, 3.0), "b": (5.0, 5.0)}
    rows = prepare.minmax_scale(other, ranges).collect()
    assert [r.a for r in rows[:3]] == [2.0, None, 0.0] and [r.b for r in rows] == [2.0, None, 0.0, 0.0] and rows[0].c == 1.0
    means = prepare.fit_means(train, ["a", "b", "c"])
    assert means == {"a": 2.0, "b": 5.0}
    assert [(r.a, r.b) for r in prepare.impute_mean(other, means).collect()][1] == (2.0, 5.0)
    limits = prepare.fit_limits(train, ["a", "c"], 2.0)
    assert limits == {"a": (0.0, 4.0)}
    assert [r.a for r in prepare.drop_outliers(other, limits).collect()] == [None, 1.0]
    assert prepare.fit_ranges(train.limit(0), ["a"]) == {} and prepare.drop_outliers(other, {}).count() == 4


def test_columns_that_occur_twice_stop_a_join(spark):
    sales = spark.createDataFrame([("u", "i", 1)], "customer_id string, article_id string, age int")
    customers = spark.createDataFrame([("u", 2)], "customer_id string, AGE int")
    articles = spark.createDataFrame([("i",)], "article_id string")
    with pytest.raises(ValueError, match="age"):
        joins.star_join(sales, customers, articles)
    assert joins.star_join(sales.drop("age"), customers, articles).count() == 1


def test_cold_items_are_found_by_their_features(spark):
    """Factors that follow from features, with noise: held-out items get the users that popularity can't name."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 12))
    factors = x @ rng.normal(size=(12, 5)) + 0.7 + rng.normal(size=(600, 5)) * 0.1
    rows = [(f"i{k:04d}", a.tolist(), b.tolist()) for k, (a, b) in enumerate(zip(x, factors, strict=True))]
    rows[5] = (rows[5][0], [None, float("nan"), *rows[5][1][2:]], rows[5][2])
    items = spark.createDataFrame(rows, "item string, f array<double>, v array<float>").repartition(5)
    warm, cold = items.where("item < 'i0500'"), items.where("item >= 'i0500'")
    weights = cold_items.fit_feature_map(items.drop("v"), warm, "item", "f", "v")
    assert weights.shape == (13, 5)
    made = {r.item: np.array(r.v) for r in cold_items.mapped_vectors(cold, weights, "item", "f", "v").collect()}
    assert len(made) == 100
    users = rng.normal(size=(50, 5))
    true, found = users @ factors[500:].T, users @ np.array([made[f"i{k:04d}"] for k in range(500, 600)]).T
    hits = np.mean([len(set(np.argsort(-a)[:10]) & set(np.argsort(-b)[:10])) for a, b in zip(true, found, strict=True)])
    popular = np.argsort(-true.sum(0))[:10]
    by_popularity = np.mean([len(set(np.argsort(-a)[:10]) & set(popular)) for a in true])
    assert hits > 8 > 2 * by_popularity
    assert cold_items.fit_feature_map(items.drop("v").limit(0), warm, "item", "f", "v") is None
