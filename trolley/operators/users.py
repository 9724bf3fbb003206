"""User-level features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trolley.columns import DEFAULT, Columns
from trolley.functions.calendar import is_weekend
from trolley.operators.favorites import favorite, favorites
from trolley.operators.joins import skew_join


def mean_gap_days(time: str) -> Column:
    """Mean of the calendar-day gaps between consecutive events; null below two events.

    The gaps add up to the distance between first and last event, so no ordering is needed.
    """
    gaps = F.count(time) - 1
    span = F.datediff(F.max(time), F.min(time))
    return F.when(gaps > 0, span / F.nullif(gaps, F.lit(0)))


def purchase_gap(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    return df.groupBy(cols.user).agg(mean_gap_days(cols.time).alias("avg_purchase_gap_days"))


def purchase_gap_events(df: DataFrame, cols: Columns = DEFAULT, slice_unit: str = "day") -> DataFrame:
    """Each event with the user's previous event time and the gap in calendar days.

    Events are ordered by time, then item (null first); null users are one user, repeated events
    follow each other. A user's history is never sorted in one task: equal events are counted,
    equal times collapsed, ``lag`` runs inside calendar slices of the history, and only the
    last time of each slice is carried to the next one.
    """
    # A repeated event keeps one row with its number, so the first of a time is one row as well.
    events = df.groupBy(cols.user, cols.item, cols.time).agg(F.count(F.lit(1)).alias("_events"))
    times = (
        events.groupBy(cols.user, cols.time)
        .agg(F.min(F.struct(F.col(cols.item).alias("item"))).alias("_first"))
        .withColumn("_slice", F.date_trunc(slice_unit, cols.time))
    )
    slices = times.groupBy(cols.user, "_slice").agg(F.max(cols.time).alias("_last"))
    by_slice = Window.partitionBy(cols.user).orderBy("_slice")
    carried = slices.select(cols.user, "_slice", F.lag("_last").over(by_slice).alias("_carried"))
    inside = Window.partitionBy(cols.user, "_slice").orderBy(cols.time)
    lagged = times.withColumn("_inside", F.lag(cols.time).over(inside))
    previous = skew_join(lagged, carried, [cols.user, "_slice"], "inner", null_keys=True).select(
        cols.user, cols.time, "_first", F.coalesce("_inside", "_carried").alias("_previous")
    )
    joined = skew_join(events, previous, [cols.user, cols.time], "inner", null_keys=True)
    leads = F.col(cols.item).eqNullSafe(F.col("_first.item")) & (F.col("_copy") == 0)
    before = F.when(leads, F.col("_previous")).otherwise(F.col(cols.time))
    return (
        joined.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_events") - 1)).alias("_copy"))
        .select(cols.user, cols.item, cols.time, before.alias("previous_purchase"))
        .withColumn("gap_days", F.datediff(cols.time, "previous_purchase"))
    )


def purchase_recency(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Add the user's latest event time and the days from each event to it."""
    latest = df.groupBy(cols.user).agg(F.max(cols.time).alias("last_purchase_ts"))
    return skew_join(df, latest, cols.user, computed=True).withColumn(
        "days_since_last_purchase", F.datediff("last_purchase_ts", cols.time)
    )


def customer_features(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Purchases, mean spend, favourite category and last purchase per user."""
    base = df.groupBy(cols.user).agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.avg(cols.price).alias("avg_spend"),
        F.max(cols.day).alias("last_purchase"),
    )
    liked = favorite(df, cols.category, "favorite_category", cols)
    return base.join(liked, cols.user, "left").select(
        cols.user, "purchase_count", "avg_spend", "favorite_category", "last_purchase"
    )


def user_features(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """The user feature table: volume, spend, weekend share, diversity, favourites, mean gap."""
    base = df.groupBy(cols.user).agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.avg(cols.price).alias("avg_spend"),
        F.avg(is_weekend(cols.time)).alias("weekend_ratio"),
        mean_gap_days(cols.time).alias("avg_purchase_gap_days"),
    )
    liked = favorites(
        df,
        {
            "preferred_channel": cols.channel,
            "favorite_category": cols.category,
            "favorite_color": cols.color,
        },
        cols,
        distinct={"category_diversity": cols.category},
    )
    return base.join(liked, cols.user, "left").select(
        cols.user,
        "purchase_count",
        "avg_spend",
        "weekend_ratio",
        "category_diversity",
        "preferred_channel",
        "favorite_category",
        "favorite_color",
        "avg_purchase_gap_days",
    )


def user_mode_features(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Per user of a two-tower table: constant features, preferred weekday and month, weekend share."""
    base = df.groupBy(cols.user).agg(
        F.min("purchase_count").alias("purchase_count"),
        F.min("avg_spend").alias("avg_spend"),
        F.avg("is_weekend").alias("is_weekend"),
        F.min("favorite_category").alias("favorite_category"),
        F.min("favorite_color").alias("favorite_color"),
    )
    modes = favorites(df, {"day_of_week": "day_of_week", "month": "month"}, cols)
    return base.join(modes, cols.user, "left").select(
        cols.user,
        "purchase_count",
        "avg_spend",
        "day_of_week",
        "month",
        "is_weekend",
        "favorite_category",
        "favorite_color",
    )


def sales_summary(transactions: DataFrame, customers: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Total, mean and number of sales of every known customer with a purchase.

    Sales are summed before the join, so the join moves one row per user.
    """
    sums = transactions.groupBy(cols.user).agg(
        F.sum(cols.price).alias("total_sales"),
        F.avg(cols.price).alias("avg_sales"),
        F.count(cols.price).alias("total_orders"),
    )
    return sums.join(customers.select(cols.user), cols.user, "inner")
