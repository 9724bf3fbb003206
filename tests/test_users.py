import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.operators import favorites, users

LOG = (
    "customer_id string, article_id string, event_timestamp timestamp_ntz, price double, "
    "product_group_name string, colour_group_name string, sales_channel_id bigint"
)


def event(user, item, time, category=None, price=1.0):
    return (user, item, dt.datetime.fromisoformat(time) if time else None, price, category, "red", 1)


def test_ties_go_to_the_lower_value_and_null_loses_ties(spark):
    rows = [
        event("u", "1", "2020-01-01", "b"),
        event("u", "2", "2020-01-01", "a"),
        event("u", "3", "2020-01-01", None),
        event("v", "1", "2020-01-01", None),
        event("v", "2", "2020-01-01", None),
        event("v", "3", "2020-01-01", "a"),
    ]
    out = favorites.favorite(spark.createDataFrame(rows, LOG), "product_group_name", "liked")
    assert {r.customer_id: r.liked for r in out.collect()} == {"u": "a", "v": None}


def test_one_purchase_has_no_gap(spark):
    rows = [event("u", "1", "2020-01-01"), event("v", "1", "2020-01-01"), event("v", "2", "2020-01-05")]
    out = users.purchase_gap(spark.createDataFrame(rows, LOG))
    assert {r[0]: r[1] for r in out.collect()} == {"u": None, "v": 4.0}


def test_gaps_are_calendar_days_and_weekend_is_sunday_and_saturday(spark):
    rows = [event("u", "1", "2024-01-06T23:00:00", "a"), event("u", "2", "2024-01-07T01:00:00", "a"),
            event("u", "3", "2024-01-08T01:00:00", "a"), event("u", "4", "2024-01-09T01:00:00", "a")]
    row = users.user_features(spark.createDataFrame(rows, LOG)).first()
    assert row.avg_purchase_gap_days == 1.0
    assert row.weekend_ratio == 0.5
    assert row.category_diversity == 1


def test_gap_events_equal_a_sorted_walk(spark):
    chosen = random.Random(3)
    start = dt.datetime(2020, 1, 1)
    keys = set()
    while len(keys) < 400:
        user = "hot" if chosen.random() < 0.4 else f"u{chosen.randrange(12)}"
        minutes = chosen.choice([0, 5, 60 * chosen.randrange(48), 60 * 24 * chosen.randrange(90)])
        keys.add((user, start + dt.timedelta(minutes=minutes), f"i{chosen.randrange(30)}"))
    rows = [(u, i, t, 1.0, "c", "r", 1) for u, t, i in keys]
    expected, last = {}, {}
    for u, t, i in sorted(keys):
        expected[(u, i, t)] = last.get(u)
        last[u] = t
    df = spark.createDataFrame(rows, LOG).repartition(5)
    for unit in ("hour", "day", "month"):
        found = users.purchase_gap_events(df, slice_unit=unit).collect()
        assert {(r[0], r[1], r[2]): r.previous_purchase for r in found} == expected
        assert len(found) == len(rows)


def test_gap_events_of_nulls_and_copies_equal_lag(spark):
    rows = [event(u, i, t) for u, i, t in [("u", None, "2020-01-01"), ("u", "1", "2020-01-01"), ("u", "1", "2020-01-03"), ("u", "1", "2020-01-03"), (None, "2", "2020-01-02"), (None, "2", "2020-01-05"), (None, None, "2020-01-05"), ("v", "3", None), ("v", "3", "2020-02-01")]]
    df = spark.createDataFrame(rows, LOG).repartition(3)
    user, item, time = df.columns[0], df.columns[1], users.DEFAULT.time
    order = Window.partitionBy(user).orderBy(time, item)
    want = df.select(user, item, time, F.lag(time).over(order).alias("p")).collect()
    found = users.purchase_gap_events(df).drop("gap_days").collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, map(tuple, want)))


def test_recency_counts_back_from_the_latest_purchase(spark):
    rows = [event("u", "1", "2020-01-01"), event("u", "2", "2020-01-11")]
    out = users.purchase_recency(spark.createDataFrame(rows, LOG))
    assert sorted(r.days_since_last_purchase for r in out.collect()) == [0, 10]
