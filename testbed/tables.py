"""Raw interaction tables derived from the driver's parquet files.

The files are clean, so gaps, odd case, spaces and bad prices are put in by arithmetic on keys
(the SQL twins use the same arithmetic). Prices are whole cents: their sums are exact in any
order, so averages are equal bit by bit in every engine.
"""

from __future__ import annotations

import zipfile

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.functions.keys import pad_id
from trolley.functions.scratch import materialize, scratch_path
from trolley.operators import clean


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


def gap(key: str, step: int, value: Column) -> Column:
    """``value``, null on every ``step``-th key."""
    return F.when(~every(key, step), value)


def raw_transactions(spark: SparkSession, folder: str) -> DataFrame:
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice"
    )
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    number = F.col("o_custkey").cast("string")
    cents = F.round(F.col("l_extendedprice") * 100)
    # Lines are spread by order before anything else: one file may be a single scan task.
    spread = lines.repartition("l_orderkey")
    return spread.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(every("l_orderkey", 101), None)
        .when(every("l_linenumber", 5), F.concat(F.lit("  C"), number, F.lit(" ")))
        .otherwise(F.concat(F.lit("c"), number))
        .alias("customer_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("o_orderdate").alias("t_dat"),
        F.when(every("l_orderkey", 97), -cents)
        .when(every("l_orderkey", 89), None)
        .otherwise(cents)
        .alias("price"),
        (F.col("l_orderkey") % 2 + 1).alias("sales_channel_id"),
    )


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    key = "c_custkey"
    number = F.col(key).cast("string")
    return load(spark, folder, "customer").select(
        F.when(every(key, 3), F.concat(F.lit(" C"), number, F.lit(" ")))
        .otherwise(F.concat(F.lit("c"), number))
        .alias("customer_id"),
        gap(key, 10, (F.col(key) % 2).cast("double")).alias("FN"),
        gap(key, 3, F.lit(1.0)).alias("Active"),
        gap(key, 10, F.concat(F.lit("  "), F.col("c_mktsegment"))).alias("club_member_status"),
        gap(key, 7, F.when(every(key, 2), "Regularly").otherwise(" NONE")).alias(
            "fashion_news_frequency"
        ),
        gap(key, 10, F.col("c_acctbal")).alias("age"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("postal_code"),
    )


# Derived code columns of an article: prefix, number suffix, name suffix, codes.
CODED = (
    ("graphical_appearance", "no", "name", 30),
    ("perceived_colour_value", "id", "name", 8),
    ("perceived_colour_master", "id", "name", 20),
    ("department", "no", "name", 250),
    ("index_group", "no", "name", 5),
    ("section", "no", "name", 57),
    ("garment_group", "no", "name", 21),
)


def raw_articles(spark: SparkSession, folder: str) -> DataFrame:
    key = "p_partkey"
    size = F.col("p_size").cast("bigint")
    coded = []
    for prefix, number, name, codes in CODED:
        code = F.col(key) % codes
        coded.append(code.alias(f"{prefix}_{number}"))
        coded.append(F.concat(F.lit(f"{prefix} "), code.cast("string")).alias(f"{prefix}_{name}"))
    letter = F.char(F.lit(65) + F.col(key) % 10)
    return load(spark, folder, "part").select(
        F.col(key).alias("article_id"),
        gap(key, 50, F.floor(F.col(key) / 10).cast("bigint")).alias("product_code"),
        gap(key, 40, F.col("p_name")).alias("prod_name"),
        gap(key, 11, size).alias("product_type_no"),
        F.concat(F.lit("Type "), size.cast("string")).alias("product_type_name"),
        gap(key, 13, F.col("p_type")).alias("product_group_name"),
        (F.col(key) % 50).alias("colour_group_code"),
        F.col("p_brand").alias("colour_group_name"),
        letter.alias("index_code"),
        F.concat(F.lit(" Index "), letter).alias("index_name"),
        *coded,
        gap(key, 17, F.concat(F.lit(" Desc "), F.col("p_name"), F.lit(" "))).alias("detail_desc"),
    )


def raw_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors keyed by unpadded item id; every fifth item has a later, negated copy."""
    stored = load(spark, folder, "embeddings")
    first = stored.select(
        F.col("vec_id").cast("string").alias("article_id"),
        F.col("embedding").alias("image_embedding"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("event_timestamp"),
    )
    again = stored.where(every("vec_id", 5)).select(
        pad_id("vec_id").alias("article_id"),
        F.transform("embedding", lambda x: -x).alias("image_embedding"),
        F.lit("2020-06-01").cast("timestamp_ntz").alias("event_timestamp"),
    )
    return first.unionByName(again)


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_transactions(raw_transactions(spark, folder))


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_customers(raw_customers(spark, folder))


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return clean.clean_articles(raw_articles(spark, folder))


def stored_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Clean transactions written once, for queries that read the log more than once."""
    return materialize(transactions(spark, folder), "transactions")


def stored_purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases with their groups written once."""
    return materialize(purchases(spark, folder), "purchases")


def star(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return stored_transactions(spark, folder), customers(spark, folder), articles(spark, folder)


def item_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Text attributes of the articles only: no number has to be filled for them."""
    raw = raw_articles(spark, folder)
    text = raw.select("article_id", *clean.string_columns(raw))
    return clean.impute_constant(clean.normalize_ids(clean.normalize_strings(text)))


def purchases(spark: SparkSession, folder: str) -> DataFrame:
    """Clean transactions with category and colour of the article."""
    groups = item_groups(spark, folder).select(
        "article_id", "product_group_name", "colour_group_name"
    )
    return transactions(spark, folder).join(groups, "article_id", "left")


def user_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """One query vector per customer, taken from the stored vectors in turn."""
    stored = load(spark, folder, "embeddings")
    size = stored.agg(F.count(F.lit(1)).alias("n")).scalar()
    users = load(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("customer_id"),
        (F.col("c_custkey") % size).alias("vec_id"),
    )
    return users.join(stored, "vec_id").select(
        "customer_id", F.col("embedding").alias("image_embedding")
    )


def clustered_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """The stored vectors made small, around one point for each label: clusters, unlike the given ones."""
    near = F.transform(
        "embedding", lambda x, i: x.cast("double") * 0.2 + F.when(i == F.col("label"), 3.0).otherwise(0.0)
    )
    return load(spark, folder, "embeddings").select("vec_id", near.cast("array<float>").alias("vector"))


# Documents packed into one archive.
DOCUMENTS_PER_ARCHIVE = 200


def image_archives(spark: SparkSession, folder: str, broken: int = 0) -> str:
    """Pack every document into zip archives as a stand-in for images; returns their folder.

    The first ``broken`` archives also have a copy that is cut in half.
    """
    target = scratch_path(spark, "archives")

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        system, inner = fs.FileSystem.from_uri(target)
        system.create_dir(inner, recursive=True)
        name = f"{inner}/archive_{frame['archive'].iloc[0]}.zip"
        with system.open_output_stream(name) as stream, zipfile.ZipFile(stream, "w") as archive:
            for doc_id, text in zip(frame["doc_id"], frame["text"]):
                data = text.encode("utf-8")
                archive.writestr(f"images/{doc_id:010d}.jpg", data)
                archive.writestr(f"notes/{doc_id:010d}.txt", data)
                archive.writestr(f"../outside/{doc_id:010d}.jpg", data)
        if frame["archive"].iloc[0] < broken:
            data = system.open_input_file(name).read()
            with system.open_output_stream(f"{inner}/cut_{frame['archive'].iloc[0]}.zip") as stream:
                stream.write(data[: len(data) // 2])
        return pd.DataFrame({"rows": [len(frame)]})

    documents = load(spark, folder, "documents").select(
        F.floor(F.col("doc_id") / DOCUMENTS_PER_ARCHIVE).cast("bigint").alias("archive"),
        "doc_id",
        "text",
    )
    packed = documents.groupBy("archive").applyInPandas(pack, "rows bigint")
    packed.write.format("noop").mode("overwrite").save()
    return target
