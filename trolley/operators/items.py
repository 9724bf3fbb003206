"""Item-level features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, ITEM_CODES, Columns
from trolley.functions.keys import pad_id
from trolley.operators.clean import dedup_latest


def item_popularity(df: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Purchases, distinct buyers and mean price per item, in one aggregation."""
    return df.groupBy(cols.item).agg(
        F.count(F.lit(1)).alias("item_purchase_count"),
        F.count_distinct(cols.user).alias("unique_buyers"),
        F.avg(cols.price).alias("avg_item_price"),
    )


def dedup_embeddings(embeddings: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """Padded id and vector, the latest vector per item; rows without id or vector are left out."""
    named = embeddings.select(
        pad_id(cols.item).alias(cols.item), F.col(cols.vector), F.col(cols.time)
    ).where(F.col(cols.item).isNotNull() & F.col(cols.vector).isNotNull())
    return dedup_latest(named, cols.item, cols.time).select(cols.item, cols.vector)


def item_features(
    df: DataFrame, embeddings: DataFrame, cols: Columns = DEFAULT, codes: tuple[str, ...] = ITEM_CODES
) -> DataFrame:
    """The item feature table: popularity, codes, days since last sale, vector and its flag."""
    base = df.groupBy(pad_id(cols.item).alias(cols.item)).agg(
        F.count(F.lit(1)).alias("item_purchase_count"),
        F.count_distinct(cols.user).alias("unique_buyers"),
        F.avg(cols.price).alias("avg_item_price"),
        *[F.min(c).alias(c) for c in codes],
        F.max(cols.time).alias("_last_sale"),
    )
    newest = df.agg(F.max(cols.time).alias("newest")).scalar()
    dated = base.withColumn("days_since_last_sale", F.datediff(newest, "_last_sale"))
    joined = dated.join(dedup_embeddings(embeddings, cols), cols.item, "left")
    return joined.select(
        cols.item,
        "item_purchase_count",
        "unique_buyers",
        "avg_item_price",
        *codes,
        "days_since_last_sale",
        cols.vector,
        F.col(cols.vector).isNotNull().cast("int").alias("embedding_available"),
    )
