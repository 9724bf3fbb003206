"""Dense ids, vocabularies and typed matrices: dimension tables instead of in-memory lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.columns import DEFAULT, ITEM_CODES, ITEM_NUMERICS, USER_NUMERICS, Columns
from trolley.functions.keys import pad_id
from trolley.functions.ordered import dense_index
from trolley.operators.items import dedup_embeddings

OUT_OF_VOCABULARY = 0


def user_index(users: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """``(user, customer_idx)``, contiguous from 0 in id order."""
    return dense_index(users, cols.user, "customer_idx")


def item_index(items: DataFrame, cols: Columns = DEFAULT) -> DataFrame:
    """``(item, article_idx)``, contiguous from 0 in order of the padded id."""
    return dense_index(items.select(pad_id(cols.item).alias(cols.item)), cols.item, "article_idx")


def vocabulary(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values without null, numbered from 1; 0 stays free for unknown values."""
    return dense_index(df, column, f"{column}_idx", start=OUT_OF_VOCABULARY + 1)


def encode_categories(df: DataFrame, vocabularies: dict[str, DataFrame]) -> DataFrame:
    """Add ``<column>_idx`` for each column; a value outside its vocabulary becomes 0.

    A vocabulary holds the distinct values of a category, so Spark broadcasts it when its
    measured size allows.
    """
    result = df
    for column, table in vocabularies.items():
        index = f"{column}_idx"
        known = table.select(column, index)
        result = result.join(known, column, "left").withColumn(
            index, F.coalesce(index, F.lit(OUT_OF_VOCABULARY))
        )
    added = [f"{c}_idx" for c in vocabularies]
    return result.select(*df.columns, *added)


def align_items(
    items: DataFrame, embeddings: DataFrame, cols: Columns = DEFAULT
) -> DataFrame:
    """Items that have a vector, one row each, joined by padded id."""
    named = items.withColumn(cols.item, pad_id(cols.item)).drop(cols.vector)
    return named.join(dedup_embeddings(embeddings, cols), cols.item, "inner")


def encode_user_matrix(
    users: DataFrame, features: Sequence[str] = USER_NUMERICS, cols: Columns = DEFAULT
) -> DataFrame:
    """User id and numeric features as float, null as 0."""
    return users.select(
        cols.user, *[F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).alias(c) for c in features]
    )


def encode_item_matrix(
    items: DataFrame,
    numerics: Sequence[str] = ITEM_NUMERICS,
    codes: Sequence[str] = ITEM_CODES,
    cols: Columns = DEFAULT,
) -> DataFrame:
    """Item id, numeric features as float with null as 0, codes as int with null as -1."""
    return items.select(
        cols.item,
        *[F.coalesce(F.col(c).cast("float"), F.lit(0.0).cast("float")).alias(c) for c in numerics],
        *[F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in codes],
    )
