"""The ranking feature table: one row per purchase with user and item features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, Columns
from trolley.functions.calendar import is_weekend
from trolley.functions.keys import pad_id
from trolley.operators.joins import skew_join


def ranking_features(
    interactions: DataFrame, users: DataFrame, items: DataFrame, cols: Columns = DEFAULT
) -> DataFrame:
    """Inner join of purchases with the user and item feature tables, plus relative price."""
    facts = interactions.select(
        cols.user, pad_id(cols.item).alias(cols.item), cols.channel, cols.time
    )
    user_side = users.select(
        cols.user, "purchase_count", "avg_spend", "category_diversity", "avg_purchase_gap_days"
    )
    item_side = items.select(
        pad_id(cols.item).alias(cols.item),
        "item_purchase_count",
        "avg_item_price",
        "days_since_last_sale",
        "embedding_available",
    )
    joined = skew_join(facts, user_side, cols.user, "inner")
    joined = skew_join(joined, item_side, cols.item, "inner")
    relative_price = F.when(
        F.col("avg_spend") > 0, F.col("avg_item_price") / F.col("avg_spend")
    ).otherwise(F.lit(0.0))
    return joined.select(
        cols.user,
        cols.item,
        "embedding_available",
        "purchase_count",
        "avg_spend",
        "category_diversity",
        "avg_purchase_gap_days",
        "item_purchase_count",
        "avg_item_price",
        "days_since_last_sale",
        relative_price.alias("price_affinity"),
        cols.channel,
        F.dayofweek(cols.time).alias("day_of_week"),
        F.month(cols.time).alias("month"),
        is_weekend(cols.time).alias("is_weekend"),
    )
