"""The wide interaction tables: one row per purchase with every attribute and statistic.

User and item statistics are joined to the small dimension tables first, so the purchases
themselves are joined only twice: once by user, once by item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, Columns
from trolley.functions.calendar import temporal_features
from trolley.operators.favorites import favorites
from trolley.operators.items import item_popularity
from trolley.operators.joins import require_distinct_columns, skew_join


def _before(df: DataFrame, time: str, as_of: object | None) -> DataFrame:
    return df if as_of is None else df.where(F.col(time) < F.lit(as_of))


def ranking_interactions(
    transactions: DataFrame,
    customers: DataFrame,
    articles: DataFrame,
    cols: Columns = DEFAULT,
    as_of: object | None = None,
) -> DataFrame:
    """Purchases with attributes, user and item statistics, calendar parts and ``label`` 1.

    With ``as_of``, statistics use purchases before that time only and rows start at it, so no
    later purchase leaks into a feature.
    """
    require_distinct_columns(transactions, customers.drop(cols.user), articles.drop(cols.item))
    timed = transactions.withColumn(cols.time, F.col(cols.day))
    known = _before(timed, cols.time, as_of)
    categories = articles.select(cols.item, cols.category)
    user_stats = (
        skew_join(known.select(cols.user, cols.item, cols.price, cols.time), categories, cols.item)
        .groupBy(cols.user)
        .agg(
            F.avg(cols.price).alias("user_avg_price"),
            F.count(F.lit(1)).alias("user_total_interactions"),
            F.count_distinct(cols.category).alias("user_category_diversity"),
            F.max(cols.time).alias("last_purchase_ts"),
        )
    )
    item_stats = known.groupBy(cols.item).agg(
        F.count(F.lit(1)).alias("item_popularity"),
        F.avg(cols.price).alias("item_avg_price"),
        F.count_distinct(cols.user).alias("unique_buyers"),
    )
    users = user_stats.join(customers, cols.user, "full" if as_of is not None else "left")
    items = item_stats.join(articles, cols.item, "full" if as_of is not None else "left")
    facts = timed if as_of is None else timed.where(F.col(cols.time) >= F.lit(as_of))
    wide = skew_join(facts, users, cols.user, computed=True)
    wide = skew_join(wide, items, cols.item, computed=True)
    featured = temporal_features(wide, cols).withColumns(
        {
            "price_affinity": F.abs(F.col("user_avg_price") - F.col(cols.price)),
            "popularity_price_score": F.col("item_popularity") * F.col(cols.price),
            "days_since_last_purchase": F.datediff("last_purchase_ts", cols.time),
            "label": F.lit(1),
        }
    )
    return featured.select(
        *timed.columns,
        *[c for c in customers.columns if c != cols.user],
        *[c for c in articles.columns if c != cols.item],
        "user_avg_price",
        "user_total_interactions",
        "user_category_diversity",
        "item_popularity",
        "item_avg_price",
        "unique_buyers",
        "day_of_week",
        "month",
        "year",
        "is_weekend",
        "price_affinity",
        "popularity_price_score",
        "last_purchase_ts",
        "days_since_last_purchase",
        "label",
    )


def two_tower_interactions(
    transactions: DataFrame,
    customers: DataFrame,
    articles: DataFrame,
    cols: Columns = DEFAULT,
    as_of: object | None = None,
) -> DataFrame:
    """Purchases with attributes, calendar parts, user summary, item popularity and favourites."""
    require_distinct_columns(transactions, customers.drop(cols.user), articles.drop(cols.item))
    known = _before(transactions, cols.time, as_of)
    groups = articles.select(cols.item, cols.category, cols.color)
    narrow = skew_join(known.select(cols.user, cols.item), groups, cols.item)
    totals = known.groupBy(cols.user).agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.avg(cols.price).alias("avg_spend"),
        F.max(cols.day).alias("last_purchase"),
    )
    liked = favorites(
        narrow, {"favorite_category": cols.category, "favorite_color": cols.color}, cols
    )
    summary = totals.join(liked, cols.user, "left")
    popularity = item_popularity(known, cols)
    users = summary.join(customers, cols.user, "full" if as_of is not None else "left")
    items = popularity.join(articles, cols.item, "full" if as_of is not None else "left")
    facts = transactions if as_of is None else transactions.where(F.col(cols.time) >= F.lit(as_of))
    wide = skew_join(facts, users, cols.user, computed=True)
    wide = skew_join(wide, items, cols.item, computed=True)
    return temporal_features(wide, cols).select(
        *transactions.columns,
        *[c for c in customers.columns if c != cols.user],
        *[c for c in articles.columns if c != cols.item],
        "day_of_week",
        "month",
        "year",
        "is_weekend",
        "purchase_count",
        "avg_spend",
        "favorite_category",
        "last_purchase",
        "item_purchase_count",
        "unique_buyers",
        "avg_item_price",
        "favorite_color",
    )
