"""Column names and schemas of the interaction model.

Every operator takes a ``Columns`` so that the same code runs on any log with a
user, an item, a time and a price.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class Columns:
    user: str = "customer_id"
    item: str = "article_id"
    day: str = "t_dat"
    time: str = "event_timestamp"
    price: str = "price"
    channel: str = "sales_channel_id"
    category: str = "product_group_name"
    color: str = "colour_group_name"
    vector: str = "image_embedding"


DEFAULT = Columns()

ITEM_ID_WIDTH = 10

# Attribute codes carried from the item dimension into the item feature table.
ITEM_CODES = (
    "department_no",
    "product_type_no",
    "section_no",
    "garment_group_no",
    "colour_group_code",
    "index_group_no",
)

# Numeric features of a user, an item and a training row, in matrix order.
USER_NUMERICS = (
    "purchase_count",
    "avg_spend",
    "weekend_ratio",
    "category_diversity",
    "preferred_channel",
    "avg_purchase_gap_days",
)
ITEM_NUMERICS = ("item_purchase_count", "unique_buyers", "avg_item_price", "days_since_last_sale")
TRAINING_USER_NUMERICS = ("purchase_count", "avg_spend")
TRAINING_ITEM_NUMERICS = ("item_purchase_count", "unique_buyers", "avg_item_price")

# Numeric inputs of a wide ranking row.
RANKING_NUMERICS = (
    "user_avg_price",
    "user_total_interactions",
    "user_category_diversity",
    "item_popularity",
    "item_avg_price",
    "unique_buyers",
    "day_of_week",
    "month",
    "is_weekend",
    "price_affinity",
    "popularity_price_score",
    "days_since_last_purchase",
)

TRANSACTIONS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("article_id", T.StringType()),
        T.StructField("t_dat", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("sales_channel_id", T.LongType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("FN", T.DoubleType()),
        T.StructField("Active", T.DoubleType()),
        T.StructField("club_member_status", T.StringType()),
        T.StructField("fashion_news_frequency", T.StringType()),
        T.StructField("age", T.DoubleType()),
        T.StructField("postal_code", T.StringType()),
    ]
)

ARTICLES = T.StructType(
    [
        T.StructField("article_id", T.LongType()),
        T.StructField("product_code", T.LongType()),
        T.StructField("prod_name", T.StringType()),
        T.StructField("product_type_no", T.LongType()),
        T.StructField("product_type_name", T.StringType()),
        T.StructField("product_group_name", T.StringType()),
        T.StructField("graphical_appearance_no", T.LongType()),
        T.StructField("graphical_appearance_name", T.StringType()),
        T.StructField("colour_group_code", T.LongType()),
        T.StructField("colour_group_name", T.StringType()),
        T.StructField("perceived_colour_value_id", T.LongType()),
        T.StructField("perceived_colour_value_name", T.StringType()),
        T.StructField("perceived_colour_master_id", T.LongType()),
        T.StructField("perceived_colour_master_name", T.StringType()),
        T.StructField("department_no", T.LongType()),
        T.StructField("department_name", T.StringType()),
        T.StructField("index_code", T.StringType()),
        T.StructField("index_name", T.StringType()),
        T.StructField("index_group_no", T.LongType()),
        T.StructField("index_group_name", T.StringType()),
        T.StructField("section_no", T.LongType()),
        T.StructField("section_name", T.StringType()),
        T.StructField("garment_group_no", T.LongType()),
        T.StructField("garment_group_name", T.StringType()),
        T.StructField("detail_desc", T.StringType()),
    ]
)

EMBEDDINGS = T.StructType(
    [
        T.StructField("article_id", T.StringType()),
        T.StructField("image_embedding", T.ArrayType(T.FloatType())),
        T.StructField("event_timestamp", T.TimestampNTZType()),
    ]
)
