"""One query per operator, each a function of (spark, folder of parquet files)."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from testbed import tables as t
from trolley.columns import (
    ITEM_CODES,
    RANKING_NUMERICS,
    TRAINING_ITEM_NUMERICS,
    TRAINING_USER_NUMERICS,
    Columns,
)
from trolley.functions import calendar, vectors
from trolley.functions.scratch import materialize, scratch_path
from trolley.operators import (
    clean,
    cold_items,
    encoding,
    favorites,
    images,
    interactions,
    inverted,
    items,
    joins,
    metrics,
    models,
    nearest,
    prepare,
    profile,
    ranking,
    recommend,
    scaling,
    split,
    training,
    users,
)
from trolley.sources import archives, batch_sink, sinks, tables
from trolley.streaming import chunks, states

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EVENTS = Columns(
    user="user_id",
    item="event_type",
    day="ts",
    time="ts",
    price="value",
    category="event_type",
    color="event_type",
    channel="event_type",
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def vector_text(column: str | Column) -> Column:
    """A vector as text of millionths: comparable across engines."""
    source = F.col(column) if isinstance(column, str) else column
    millionths = F.transform(
        source.cast("array<double>"), lambda x: F.round(x * 1_000_000).cast("bigint").cast("string")
    )
    return F.array_join(millionths, ",")


def vector_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Stored vectors as text, made once an item: for rows that are joined with them many times an item."""
    return t.raw_embeddings(spark, folder).withColumn("image_embedding", vector_text("image_embedding"))


# --- sources and sinks ---------------------------------------------------------------------


@query
def src_raw_tables(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "raw")
    t.raw_articles(spark, folder).write.parquet(f"{base}/articles.parquet")
    t.raw_customers(spark, folder).write.parquet(f"{base}/customers.parquet")
    t.raw_transactions(spark, folder).write.parquet(f"{base}/transactions.parquet")
    articles, customers, transactions = tables.read_all_raw(spark, base)

    def digest(name: str, df: DataFrame, cents: Sequence[str] = ()) -> DataFrame:
        """A digest of each row's cells, numbers with fractions as hundredths."""
        cells = [F.round(F.col(c) * 100).cast("bigint") if c in cents else F.col(c) for c in df.columns]
        text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("-")) for c in cells])
        return df.select(F.lit(name).alias("table_name"), F.md5(text.cast("binary")).alias("cells"))

    return (
        digest("articles", articles)
        .unionByName(digest("customers", customers, ("FN", "Active", "age")))
        .unionByName(digest("transactions", transactions, ("price",)))
    )


@query
def src_normalized_ids(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    t.raw_transactions(spark, folder).select("customer_id", "article_id", "t_dat").write.parquet(path)
    return tables.read_normalized(spark, path)


@query
def src_projected(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/lineitem.parquet"
    return tables.read_columns(spark, path, ["l_orderkey", "l_partkey", "l_linenumber"])


@query
def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "sink")
    sinks.write_table(t.transactions(spark, folder), path)
    return spark.read.parquet(path)


@query
def sink_replace_partitions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "replace")
    log = t.transactions(spark, folder)
    sinks.write_table(log, path, partition_by=["sales_channel_id"])
    changed = log.where(F.col("sales_channel_id") == 2).withColumn("price", F.col("price") * 2)
    sinks.replace_partitions(changed, path, ["sales_channel_id"])
    return spark.read.parquet(path).withColumn(
        "sales_channel_id", F.col("sales_channel_id").cast("bigint")
    )


# Fixed value: rows in a file of a chunk, at most about so many.
CHUNK_FILE_ROWS = 2_000_000


def write_chunk_files(log: DataFrame, path: str, count: int, rows_per_file: int = CHUNK_FILE_ROWS) -> int:
    """Write ``log`` as ``count`` chunks of equally many files of bounded size; returns the files of a chunk."""
    per_chunk = max(1, math.ceil(log.count() / (count * rows_per_file)))
    sinks.write_table(log, path, files=count * per_chunk)
    return per_chunk


@query
def chunked_scan(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "chunks")
    log = t.stored_transactions(spark, folder)
    per_chunk = write_chunk_files(log, f"{base}/in", 4)
    chunks.process_chunks(
        spark,
        f"{base}/in",
        log.schema,
        calendar.temporal_features,
        f"{base}/out",
        f"{base}/progress",
        files_per_chunk=per_chunk,
    )
    return chunks.read_chunks(spark, f"{base}/out").drop("chunk")


# --- cleaning ------------------------------------------------------------------------------


@query
def clean_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return t.transactions(spark, folder)


@query
def clean_customers(spark: SparkSession, folder: str) -> DataFrame:
    return t.customers(spark, folder)


@query
def clean_articles(spark: SparkSession, folder: str) -> DataFrame:
    return t.articles(spark, folder)


@query
def dedup_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return clean.dedup_transactions(t.raw_transactions(spark, folder))


@query
def normalize_strings(spark: SparkSession, folder: str) -> DataFrame:
    return clean.normalize_strings(t.raw_customers(spark, folder))


@query
def impute_median(spark: SparkSession, folder: str) -> DataFrame:
    raw = t.raw_articles(spark, folder).select("article_id", "product_type_no", "section_no")
    return clean.impute_median(raw, ["product_type_no", "section_no"])


@query
def impute_constant(spark: SparkSession, folder: str) -> DataFrame:
    raw = t.raw_customers(spark, folder)
    text = raw.select(*clean.string_columns(raw))
    named = {"fashion_news_frequency": "UNKNOWN", "club_member_status": "UNKNOWN"}
    return clean.impute_constant(text, named)


# --- joins and wide tables -----------------------------------------------------------------


@query
def star_join(spark: SparkSession, folder: str) -> DataFrame:
    return joins.star_join(t.transactions(spark, folder), t.customers(spark, folder), t.articles(spark, folder))


@query
def temporal_features(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.temporal_features(t.transactions(spark, folder))


@query
def favorite_category(spark: SparkSession, folder: str) -> DataFrame:
    return favorites.favorite(t.purchases(spark, folder), "product_group_name", "favorite_category")


@query
def favorite_color(spark: SparkSession, folder: str) -> DataFrame:
    return favorites.favorite(t.purchases(spark, folder), "colour_group_name", "favorite_color")


@query
def preferred_channel(spark: SparkSession, folder: str) -> DataFrame:
    log = t.transactions(spark, folder)
    return favorites.favorite(log, "sales_channel_id", "preferred_channel")


@query
def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    return users.customer_features(t.stored_purchases(spark, folder))


@query
def item_popularity(spark: SparkSession, folder: str) -> DataFrame:
    return items.item_popularity(t.transactions(spark, folder))


@query
def purchase_recency(spark: SparkSession, folder: str) -> DataFrame:
    return users.purchase_recency(t.stored_transactions(spark, folder))


@query
def ranking_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.ranking_interactions(*t.star(spark, folder))


@query
def two_tower_interactions(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.two_tower_interactions(*t.star(spark, folder))


@query
def ranking_interactions_as_of(spark: SparkSession, folder: str) -> DataFrame:
    cut = F.lit("2000-01-01").cast("timestamp_ntz")
    return interactions.ranking_interactions(*t.star(spark, folder), as_of=cut)


@query
def customer_sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    names = clean.normalize_strings(t.raw_customers(spark, folder).select("customer_id"))
    return users.sales_summary(t.transactions(spark, folder), names)


# --- split, feature tables, statistics -----------------------------------------------------


@query
def temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.temporal_split(t.stored_transactions(spark, folder))


@query
def split_metadata(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_metadata(split.temporal_split(t.transactions(spark, folder)), "test", 64)


@query
def split_metadata_written(spark: SparkSession, folder: str) -> DataFrame:
    """The metadata as the write of the parts has counted them."""
    parts = split.temporal_split(t.stored_transactions(spark, folder))
    return sinks.write_split(parts, scratch_path(spark, "split"), "test", 64)


@query
def table_shapes_written(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "shapes")
    made = {"transactions": t.transactions, "customers": t.customers, "articles": t.articles}
    shapes = [sinks.write_counted(f(spark, folder), f"{path}/{name}", name) for name, f in made.items()]
    return shapes[0].unionByName(shapes[1]).unionByName(shapes[2])


@query
def hash_split(spark: SparkSession, folder: str) -> DataFrame:
    log = t.transactions(spark, folder).select("customer_id", "article_id", "t_dat")
    return split.hash_split(log, ["customer_id", "article_id", "t_dat"])


@query
def dedup_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    kept = items.dedup_embeddings(t.raw_embeddings(spark, folder))
    return kept.select("article_id", vector_text("image_embedding").alias("vector"))


@query
def purchase_gap(spark: SparkSession, folder: str) -> DataFrame:
    return users.purchase_gap(t.transactions(spark, folder))


@query
def purchase_gap_events(spark: SparkSession, folder: str) -> DataFrame:
    return users.purchase_gap_events(t.stored_transactions(spark, folder))


@query
def user_features(spark: SparkSession, folder: str) -> DataFrame:
    return users.user_features(t.stored_purchases(spark, folder))


def _item_table(spark: SparkSession, folder: str, log: DataFrame | None = None) -> DataFrame:
    bought = t.stored_transactions(spark, folder) if log is None else log
    codes = t.articles(spark, folder).select("article_id", *ITEM_CODES)
    coded = joins.skew_join(bought, codes, "article_id")
    return items.item_features(coded, t.raw_embeddings(spark, folder))


@query
def item_features(spark: SparkSession, folder: str) -> DataFrame:
    table = _item_table(spark, folder)
    return table.withColumn("image_embedding", vector_text("image_embedding"))


@query
def ranking_features(spark: SparkSession, folder: str) -> DataFrame:
    log = t.stored_purchases(spark, folder)
    return ranking.ranking_features(log, users.user_features(log), _item_table(spark, folder, log))


@query
def stats_numeric(spark: SparkSession, folder: str) -> DataFrame:
    stats = profile.numeric_statistics(calendar.temporal_features(t.transactions(spark, folder)))
    return stats.withColumn("std", F.round("std", 3))


@query
def stats_categorical(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["customer_id", "product_group_name", "colour_group_name"]
    return profile.categorical_statistics(t.purchases(spark, folder), columns)


@query
def stats_embedding(spark: SparkSession, folder: str) -> DataFrame:
    return profile.embedding_statistics(_item_table(spark, folder))


@query
def embedding_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return profile.embedding_coverage(_item_table(spark, folder))


@query
def feature_statistics(spark: SparkSession, folder: str) -> DataFrame:
    table = materialize(users.customer_features(t.purchases(spark, folder)), "customer-features")
    stats = profile.feature_statistics(table, "customer_features")
    # Fractions as text of thousandths: comparable across engines.
    real = (F.col("kind") == "numeric") & ~F.col("stat").isin("dtype", "count", "null_count")
    thousandths = F.round(F.col("value").cast("double"), 3).cast("decimal(30,3)").cast("string")
    return stats.withColumn("value", F.when(real, thousandths).otherwise(F.col("value")))


@query
def stats_of_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics merged from the states of four chunks; percentiles and distinct counts within their errors."""
    base = scratch_path(spark, "states")
    log = calendar.temporal_features(t.stored_transactions(spark, folder))
    per_chunk = write_chunk_files(log, f"{base}/in", 4)
    found = states.merged_statistics(
        states.update_states(spark, f"{base}/in", log.schema, f"{base}/out", f"{base}/progress", files_per_chunk=per_chunk)
    )
    exact = profile.unique_counts(log, [*profile.numeric_features(log), *profile.categorical_features(log)])
    exact = exact.withColumnRenamed("unique_count", "exact_count")
    names = profile.numeric_features(log)
    cuts = [f"p{round(p * 100):02d}" for p in profile.PERCENTILES]
    # Shares of rows below and up to each percentile, in one pass.
    wide = found.where(F.col("feature").isin(names)).groupBy().pivot("feature", names).agg(F.first(F.array(*cuts)))

    beside = log.withColumn("cuts", wide.select(F.struct(*names).alias("cuts")).scalar())

    def share(c: str, i: int, compare: Callable[[Column, Column], Column]) -> Column:
        hit = compare(F.col(c).cast("double"), F.get(F.col(f"cuts.{c}"), F.lit(i)))
        return F.avg(F.when(F.col(c).isNotNull(), hit.cast("int")))

    checked = beside.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("feature"),
                    F.array(*[share(c, i, Column.__lt__) for i in range(len(cuts))]).alias("below"),
                    F.array(*[share(c, i, Column.__le__) for i in range(len(cuts))]).alias("upto"),
                )
                for c in names
            ]
        ).alias("rows")
    ).select(F.inline("rows"))
    wanted = F.array(*[F.lit(p) for p in profile.PERCENTILES])
    slack = F.lit(states.RANK_ERROR)
    low = F.forall(F.zip_with("below", wanted, lambda s, p: s <= p + slack), lambda x: x)
    high = F.forall(F.zip_with("upto", wanted, lambda s, p: s >= p - slack), lambda x: x)
    close = F.abs(F.col("unique_count") - F.col("exact_count")) <= F.col("exact_count") * states.DISTINCT_ERROR + 1
    joined = found.join(checked, "feature", "left").join(exact, "feature")
    return joined.select(
        "feature", "count", "null_count", "min", "max", F.round("mean", 3).alias("mean"), F.round("std", 3).alias("std"),
        F.when(F.col("below").isNotNull(), (low & high).cast("int")).alias("percentiles_close"),
        close.cast("int").alias("distinct_close"),
    )


@query
def dataset_profile(spark: SparkSession, folder: str) -> DataFrame:
    log = profile.dataset_profile(t.transactions(spark, folder), "transactions")
    stored = profile.dataset_profile(t.raw_embeddings(spark, folder), "embeddings")
    return log.unionByName(stored)


@query
def column_cardinality(spark: SparkSession, folder: str) -> DataFrame:
    skip = ["article_id", "product_code"]
    return profile.column_cardinality(t.raw_articles(spark, folder), skip)


@query
def null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_profile(t.raw_customers(spark, folder))


def _two_tower(spark: SparkSession, folder: str) -> DataFrame:
    return interactions.two_tower_interactions(*t.star(spark, folder))


@query
def user_mode_features(spark: SparkSession, folder: str) -> DataFrame:
    return users.user_mode_features(_two_tower(spark, folder))


# --- training sets -------------------------------------------------------------------------


@query
def user_index(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.user_index(t.transactions(spark, folder))


@query
def item_index(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.item_index(t.transactions(spark, folder))


@query
def vocab_category(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.vocabulary(users.customer_features(t.stored_purchases(spark, folder)), "favorite_category")


@query
def vocab_color(spark: SparkSession, folder: str) -> DataFrame:
    liked = favorites.favorite(t.purchases(spark, folder), "colour_group_name", "favorite_color")
    return encoding.vocabulary(liked, "favorite_color")


@query
def align_items(spark: SparkSession, folder: str) -> DataFrame:
    popular = items.item_popularity(t.transactions(spark, folder))
    both = encoding.align_items(popular, t.raw_embeddings(spark, folder))
    return both.withColumn("image_embedding", vector_text("image_embedding"))


@query
def encode_user_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode_user_matrix(users.user_features(t.stored_purchases(spark, folder)))


@query
def encode_item_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return encoding.encode_item_matrix(_item_table(spark, folder))


@query
def encode_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Vocabularies without some categories and a colour, applied to the users of the whole log."""
    log = t.stored_purchases(spark, folder)
    wanted = {"favorite_category": "product_group_name", "favorite_color": "colour_group_name"}
    held_out = F.col("product_group_name").startswith("promo") | (F.col("colour_group_name") == "brand#11")
    seen = favorites.favorites(log.where(~held_out), wanted)
    return encoding.encode_categories(
        favorites.favorites(log, wanted), {c: encoding.vocabulary(seen, c) for c in wanted}
    )


def _indexed_items(log: DataFrame, embeddings: DataFrame) -> DataFrame:
    stored = items.dedup_embeddings(embeddings).select("article_id")
    return encoding.item_index(log.select("article_id").join(stored, "article_id", "left_semi"))


@query
def negative_samples(spark: SparkSession, folder: str) -> DataFrame:
    log = t.stored_transactions(spark, folder)
    return training.negative_samples(log, _indexed_items(log, t.raw_embeddings(spark, folder)))


def _ranking_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The log with its users' and items' numbers, and the items'."""
    log = t.stored_transactions(spark, folder)
    per_user = log.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("purchase_count"), F.avg("price").alias("avg_spend")
    )
    popular = materialize(items.item_popularity(log), "popularity")
    wide = joins.skew_join(log, per_user, "customer_id", computed=True)
    return joins.skew_join(wide, popular, "article_id"), popular


def _ranking_rows(spark: SparkSession, folder: str, embeddings: Query = t.raw_embeddings) -> DataFrame:
    wide, popular = _ranking_inputs(spark, folder)
    return training.ranking_dataset(
        materialize(wide, "ranking-log"), popular, embeddings(spark, folder), stored=True
    )


@query
def ranking_dataset(spark: SparkSession, folder: str) -> DataFrame:
    return _ranking_rows(spark, folder, vector_texts)


@query
def label_balance(spark: SparkSession, folder: str) -> DataFrame:
    return training.label_balance(_ranking_rows(spark, folder).select("label"))


@query
def two_tower_dataset(spark: SparkSession, folder: str) -> DataFrame:
    log = t.stored_transactions(spark, folder)
    return training.two_tower_dataset(
        log, encoding.user_index(log), encoding.item_index(log), vector_texts(spark, folder)
    )


def _chunked(spark: SparkSession, log: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A log in three chunks, prepared a chunk at a time."""
    base = scratch_path(spark, "training-chunks")
    per_chunk = write_chunk_files(log, f"{base}/in", 3)
    chunks.process_chunks(spark, f"{base}/in", log.schema, transform, f"{base}/out", f"{base}/progress", per_chunk)
    return chunks.read_chunks(spark, f"{base}/out").drop("chunk")


@query
def two_tower_chunks(spark: SparkSession, folder: str) -> DataFrame:
    log = t.stored_transactions(spark, folder)
    lookups = training.write_two_tower_lookups(
        encoding.user_index(log), encoding.item_index(log), vector_texts(spark, folder), scratch_path(spark, "lookups")
    )
    return _chunked(spark, log, lambda chunk: training.two_tower_chunk(chunk, lookups))


@query
def ranking_chunks(spark: SparkSession, folder: str) -> DataFrame:
    wide, popular = _ranking_inputs(spark, folder)
    wide = materialize(wide, "ranking-log")
    lookups = training.write_ranking_lookups(
        wide, popular, vector_texts(spark, folder), scratch_path(spark, "lookups")
    )
    return _chunked(spark, wide, lambda chunk: training.ranking_chunk(chunk, lookups))


@query
def retrieval_dataset(spark: SparkSession, folder: str) -> DataFrame:
    typed = training.retrieval_dataset(_two_tower(spark, folder), vector_texts(spark, folder))
    return typed.select(
        "customer_id",
        "article_id",
        "t_dat",
        vector_text("user_numeric").alias("user_numeric"),
        "user_category",
        "user_color",
        vector_text("item_numeric").alias("item_numeric"),
        vector_text("item_categorical").alias("item_categorical"),
        "image_embedding",
    )


def _user_summary(spark: SparkSession, folder: str) -> DataFrame:
    timed = calendar.temporal_features(t.transactions(spark, folder))
    return timed.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("purchase_count"),
        F.avg("price").alias("avg_spend"),
        F.avg("is_weekend").alias("is_weekend"),
    )


@query
def standard_scale(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["purchase_count", "avg_spend", "is_weekend"]
    scaled = scaling.standard_scale(_user_summary(spark, folder), columns)
    return scaled.select("customer_id", *[F.round(c, 6).alias(c) for c in columns])


def _parts_of_log(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The log with its parts, and the training part."""
    parts = split.temporal_split(t.stored_transactions(spark, folder))
    parts = parts.select("customer_id", "article_id", "t_dat", "price", "split")
    return parts, parts.where(F.col("split") == split.TRAIN)


@query
def minmax_scale(spark: SparkSession, folder: str) -> DataFrame:
    """Prices of all parts by the range of the training part."""
    parts, train = _parts_of_log(spark, folder)
    scaled = prepare.minmax_scale(parts, prepare.fit_ranges(train, ["price"]))
    return scaled.withColumn("price", F.round("price", 9))


@query
def drop_outliers(spark: SparkSession, folder: str) -> DataFrame:
    """Rows within 1.5 deviations of the training part's mean price."""
    parts, train = _parts_of_log(spark, folder)
    return prepare.drop_outliers(parts, prepare.fit_limits(train, ["price"], 1.5))


@query
def impute_mean(spark: SparkSession, folder: str) -> DataFrame:
    """Ages of all customers by the mean of two thirds of them."""
    raw = t.raw_customers(spark, folder).select("customer_id", "age", "FN")
    means = prepare.fit_means(raw.where(~F.col("customer_id").startswith(" ")), ["age", "FN"])
    filled = prepare.impute_mean(raw, means)
    return filled.select("customer_id", *[F.round(c, 6).alias(c) for c in ("age", "FN")])


@query
def assemble_vector(spark: SparkSession, folder: str) -> DataFrame:
    """Scaled item numerics followed by the scaled vector, split by hash of the item."""
    popular = items.item_popularity(t.transactions(spark, folder))
    both = encoding.align_items(popular, t.raw_embeddings(spark, folder))
    scaled = scaling.scale_vectors(
        scaling.standard_scale(both, TRAINING_ITEM_NUMERICS), "image_embedding"
    )
    combined = vectors.assemble(vectors.scalars(*TRAINING_ITEM_NUMERICS), "image_embedding")
    rows = scaled.select("article_id", vector_text(combined).alias("features"))
    return split.hash_split(rows, ["article_id"])


@query
def finite_or_zero(spark: SparkSession, folder: str) -> DataFrame:
    broken = (
        F.when(t.every("l_linenumber", 2), float("nan"))
        .when(t.every("l_linenumber", 3), float("inf"))
        .when(t.every("l_linenumber", 5), float("-inf"))
        .when(t.every("l_linenumber", 7), None)
        .otherwise(F.col("l_extendedprice"))
    )
    lines = t.load(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", broken.alias("value")
    )
    return scaling.finite_columns(lines, ["value"])


# --- vectors and recommendations -----------------------------------------------------------


@query
def vec_l2_normalize(spark: SparkSession, folder: str) -> DataFrame:
    stored = t.load(spark, folder, "embeddings")
    unit = stored.select("vec_id", F.posexplode(vectors.l2_normalize("embedding")).alias("position", "value"))
    return unit.withColumn("value", F.round("value", 6))


@query
def vec_parse(spark: SparkSession, folder: str) -> DataFrame:
    stored = t.load(spark, folder, "embeddings")
    text = F.when(t.every("vec_id", 7), "[1.0, oops").otherwise(F.to_json("embedding"))
    parsed = stored.select("vec_id", text.alias("text")).select(
        "vec_id", vectors.parse_vector("text", 64).alias("vector")
    )
    return parsed.withColumn("vector", vector_text("vector"))


@query
def vec_pair_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Dot product and cosine of each stored vector with the vector after it."""
    stored = t.load(spark, folder, "embeddings").select("vec_id", "embedding")
    following = stored.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return stored.join(following, "vec_id").select(
        "vec_id",
        F.round(vectors.dot("embedding", "next"), 6).alias("dot"),
        F.round(vectors.cosine("embedding", "next"), 6).alias("cosine"),
    )


def _item_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return items.dedup_embeddings(t.raw_embeddings(spark, folder))


@query
def vec_topk(spark: SparkSession, folder: str) -> DataFrame:
    return nearest.top_k(
        t.user_vectors(spark, folder),
        _item_vectors(spark, folder),
        recommend.CANDIDATES,
        "customer_id",
        "article_id",
        "image_embedding",
        "image_embedding",
    )


@query
def vec_cosine_topk(spark: SparkSession, folder: str) -> DataFrame:
    stored = _item_vectors(spark, folder)
    asked = stored.select(F.col("article_id").alias("query_id"), "image_embedding")
    return nearest.top_k(
        asked, stored, 10, "query_id", "article_id", "image_embedding", "image_embedding", "cosine"
    )


def _vector_lists(spark: SparkSession, folder: str) -> inverted.InvertedFile:
    return inverted.build_lists(_item_vectors(spark, folder), "article_id", "image_embedding")


@query
def vec_ivf_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The inverted file with every list probed."""
    file = _vector_lists(spark, folder)
    asked = t.user_vectors(spark, folder)
    return inverted.probed_top_k(
        file, asked, recommend.CANDIDATES, "customer_id", "article_id", "image_embedding", file.lists
    )


@query
def vec_ivf_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that the fitted number of lists returns, and whether nine tenths of the true ones are among them."""
    file, asked = _vector_lists(spark, folder), t.user_vectors(spark, folder)
    probes = inverted.fitted_probes(file, asked, recommend.CANDIDATES, "customer_id", "image_embedding")
    names = (recommend.CANDIDATES, "customer_id", "article_id", "image_embedding")
    found = inverted.probed_top_k(file, asked, *names, probes)
    true = inverted.bounded_top_k(file, asked, *names)[0].select("customer_id", "article_id", F.lit(1).alias("hit"))
    # Without the scores: both sides are shuffled, with as many rows as the searches return.
    both = true.join(found.select("customer_id", "article_id", F.lit(1).alias("found")), ["customer_id", "article_id"], "left")
    return both.agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count("hit").alias("true_rows"),
        (F.count("found") >= 0.9 * F.count("hit")).cast("int").alias("recall_reached"),
    )


@query
def vec_bounded_topk(spark: SparkSession, folder: str) -> DataFrame:
    file, asked = _vector_lists(spark, folder), t.user_vectors(spark, folder)
    return inverted.bounded_top_k(
        file, asked, recommend.CANDIDATES, "customer_id", "article_id", "image_embedding"
    )[0]


def _clustered_search(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, int]:
    stored = t.clustered_vectors(spark, folder)
    file = inverted.build_lists(stored, "vec_id", "vector")
    asked = stored.select(F.col("vec_id").alias("query_id"), "vector")
    found, rounds = inverted.bounded_top_k(file, asked, 10, "query_id", "vec_id", "vector")
    return found, rounds, int(file.sizes.sum())


@query
def vec_bounded_clustered(spark: SparkSession, folder: str) -> DataFrame:
    return _clustered_search(spark, folder)[0]


@query
def vec_bounded_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of clustered vectors, and whether at most half of them were scored."""
    _, rounds, items = _clustered_search(spark, folder)
    pairs = F.lit(items).cast("bigint") * items
    return rounds.agg(F.sum("pairs").alias("scored")).select(
        F.lit(items).cast("bigint").alias("items"), pairs.alias("all_pairs"), (F.col("scored") * 2 <= pairs).cast("int").alias("half_at_most")
    )


def _popularity_score() -> Column:
    return F.col("retrieval_score") + F.coalesce("item_purchase_count", F.lit(0)) / F.lit(100.0)


@query
def rerank_topk(spark: SparkSession, folder: str) -> DataFrame:
    popular = items.item_popularity(t.transactions(spark, folder))
    found = recommend.retrieve(
        t.user_vectors(spark, folder), _item_vectors(spark, folder), popular, used=["item_purchase_count"]
    )
    best = recommend.rerank(found, _popularity_score())
    return best.select("customer_id", "article_id", "retrieval_score", "score", "rank")


def _recommendations(
    spark: SparkSession, folder: str, method: str, score: Column, search: recommend.Search = nearest.top_k,
    used: Sequence[str] = ("item_purchase_count",),
) -> DataFrame:
    return recommend.batch_recommendations(
        t.user_vectors(spark, folder),
        _item_vectors(spark, folder),
        items.item_popularity(t.transactions(spark, folder)),
        score,
        method,
        search=search,
        used=used,
    )


@query
def batch_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    return _recommendations(spark, folder, "popularity", _popularity_score())


@query
def batch_recommendations_bounded(spark: SparkSession, folder: str) -> DataFrame:
    return _recommendations(spark, folder, "popularity", _popularity_score(), recommend.bounded_search)


@query
def rec_summary(spark: SparkSession, folder: str) -> DataFrame:
    by_popularity = _recommendations(spark, folder, "popularity", _popularity_score())
    by_vector = _recommendations(spark, folder, "vector", F.col("retrieval_score"), used=())
    summary = recommend.recommendation_summary(by_popularity.unionByName(by_vector))
    rounded = ("avg_score", "std_score", "avg_top_score")
    return summary.select(
        "method", "users", "recommendations", *[F.round(c, 4).alias(c) for c in rounded]
    )


def _export(spark: SparkSession, folder: str) -> DataFrame:
    popular = items.item_popularity(t.transactions(spark, folder))
    both = encoding.align_items(popular, t.raw_embeddings(spark, folder))
    return sinks.export_batches(
        both,
        "article_id",
        "image_embedding",
        {"popularity": F.col("item_purchase_count"), "type": F.lit("product")},
    )


def _export_rows(batches: DataFrame) -> DataFrame:
    return batches.select(
        "batch_no",
        "id",
        vector_text("vector").alias("vector"),
        F.col("metadata.popularity").alias("popularity"),
        F.col("metadata.type").alias("type"),
    )


@query
def vec_export_batches(spark: SparkSession, folder: str) -> DataFrame:
    return _export_rows(_export(spark, folder))


@query
def vec_export_sink(spark: SparkSession, folder: str) -> DataFrame:
    """The batches through the sink, whose readers see committed runs alone."""
    batches = _export(spark, folder)
    path = scratch_path(spark, "export")
    batch_sink.write_batches(batches, path)
    return _export_rows(batch_sink.read_batches(spark, path, batches.schema))


# --- models and metrics --------------------------------------------------------------------


@query
def binary_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Returned lines as the label, a repeatable number between 0 and 1 as the score."""
    mixed = (F.col("l_partkey") * 7919 + F.col("l_orderkey") * 104729) % 10007
    scored = t.load(spark, folder, "lineitem").select(
        (mixed / F.lit(10007.0)).alias("score"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
    )
    found = metrics.binary_metrics(scored)
    rounded = ("accuracy", "precision", "recall", "auc")
    return found.select("positives", "negatives", *[F.round(c, 9).alias(c) for c in rounded])


# Fixed value: rows in a file that models are fitted on. Spark reads at most 32 small files in a task (128 MB, 4 MB to
# open each), and the fit holds a row as doubles, many times its size in a file whose vectors repeat.
TRAINING_FILE_ROWS = 50_000


@query
def fit_ranker(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on four fifths of the ranking rows and measure on the rest."""
    numerics = [*TRAINING_USER_NUMERICS, *TRAINING_ITEM_NUMERICS]
    rows = materialize(
        split.hash_split(_ranking_rows(spark, folder), ["shuffle_key"]), "ranker-rows", TRAINING_FILE_ROWS
    )
    model = models.fit_ranker(
        rows.where(F.col("split") == split.TRAIN), numerics, "image_embedding"
    )
    held = rows.where(F.col("split") == split.TEST)
    found = metrics.binary_metrics(models.score_rows(model, held, numerics, "image_embedding"))
    return found.select("positives", "negatives", (F.col("auc") > 0.5).cast("int").alias("better_than_chance"))


@query
def fit_wide_ranker(spark: SparkSession, folder: str) -> DataFrame:
    """Boosted trees on the wide ranking rows: a dear purchase is one above the user's mean.

    Every fifth month is held out; its rows are scored by a model that has not seen them.
    """
    wide = ranking_interactions(spark, folder).withColumn(
        "label", (F.col("price") > F.col("user_avg_price")).cast("int")
    )
    numerics = [c for c in RANKING_NUMERICS if c not in ("price_affinity", "popularity_price_score")]
    wide = materialize(wide.select(*numerics, "year", "label"), "wide-ranker-rows", TRAINING_FILE_ROWS)
    held = (F.col("year") * 12 + F.col("month")) % 5 == 0
    model = models.fit_ranker(wide.where(~held), numerics, trees=True)
    found = metrics.binary_metrics(models.score_rows(model, wide.where(held), numerics))
    return found.select("positives", "negatives", (F.col("auc") > 0.5).cast("int").alias("better_than_chance"))


@query
def fit_retrieval(spark: SparkSession, folder: str) -> DataFrame:
    """Ten items per user by learned factors, against the ten most popular ones for everybody: how
    often the user bought them."""
    log = t.stored_transactions(spark, folder)
    user_ids, item_ids = encoding.user_index(log), encoding.item_index(log)
    model = models.fit_retrieval(log, user_ids, item_ids, rank=8, passes=3)
    asked, offered = models.factor_tables(model, user_ids, item_ids)
    lists = nearest.top_k(
        asked, offered, 10, "customer_id", "article_id", "image_embedding", "image_embedding"
    )
    pairs = log.select("customer_id", "article_id").distinct()
    popular = pairs.groupBy("article_id").count().orderBy(F.desc("count"), "article_id").limit(10)
    by_popularity = pairs.join(popular, "article_id").agg(F.count(F.lit(1)).alias("n")).scalar()
    bought = pairs.withColumn("bought", F.lit(1))
    rows = lists.join(bought, ["customer_id", "article_id"], "left").groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("bought").alias("hits")
    )
    found = rows.agg(
        F.count(F.lit(1)).alias("customers"),
        F.min("n").alias("fewest"),
        F.max("n").alias("most"),
        F.sum("hits").alias("hits"),
    )
    better = (F.col("hits") > 1.5 * by_popularity).cast("int")
    return found.select("customers", "fewest", "most", better.alias("better_than_popular"))


@query
def fit_cold_items(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of items whose purchases the factors have not seen, from their codes and stored vectors."""
    log = t.transactions(spark, folder).select("customer_id", "article_id")
    held = split.hash_split(_item_vectors(spark, folder), ["article_id"])
    codes = t.articles(spark, folder).select("article_id", *ITEM_CODES)
    wide = held.join(codes, "article_id")
    wide = materialize(
        wide.select("article_id", "split", vectors.assemble(vectors.scalars(*ITEM_CODES), F.col("image_embedding").cast("array<double>")).alias("features")),
        "item-inputs",
    )
    cold = wide.where(F.col("split") == split.TEST)
    seen = materialize(log.join(cold, "article_id", "left_anti"), "warm-log")
    user_ids, item_ids = encoding.user_index(seen), encoding.item_index(seen)
    model = models.fit_retrieval(seen, user_ids, item_ids, rank=8, passes=3)
    _, factors = models.factor_tables(model, user_ids, item_ids)
    warm = wide.where(F.col("split") == split.TRAIN)
    weights = cold_items.fit_feature_map(warm, factors, "article_id", "features", "image_embedding")
    made = cold_items.mapped_vectors(cold, weights, "article_id", "features", "vector")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x))
    return made.select("article_id", F.size("vector").alias("dimension"), finite.cast("int").alias("finite"))


# --- images --------------------------------------------------------------------------------


@query
def img_zip_members(spark: SparkSession, folder: str) -> DataFrame:
    packed = t.image_archives(spark, folder)
    return archives.list_members(spark, packed).select("archive", "member", "size")


def byte_counts() -> images.Embedder:
    """A stand-in embedding: how often five letters occur; every 13th length counts as broken."""

    def embed(batch: Sequence[bytes]) -> list[list[float] | None]:
        return [
            None if len(data) % 13 == 0 else [1.0, *[float(data.count(c)) for c in (b"a", b"e", b"i", b"n")]]
            for data in batch
        ]

    return embed


@query
def img_embed_job(spark: SparkSession, folder: str) -> DataFrame:
    found = archives.read_archives(spark, t.image_archives(spark, folder))
    embedded = images.embed_images(found, byte_counts)
    table = images.embedding_table(embedded, "2020-01-01")
    return table.withColumn("image_embedding", vector_text("image_embedding"))


@query
def img_embed_report(spark: SparkSession, folder: str) -> DataFrame:
    found = archives.read_archives(spark, t.image_archives(spark, folder))
    return images.embedding_report(images.embed_images(found, byte_counts))


@query
def img_broken_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The report of the same archives and two of them cut in half, in ranges of 64 kB."""
    packed = t.image_archives(spark, folder, broken=2)
    found = archives.read_archives(spark, packed, range_bytes=64 << 10)
    return images.embedding_report(images.embed_images(found, byte_counts))


# --- the same operators on another log -----------------------------------------------------


@query
def events_favorite_type(spark: SparkSession, folder: str) -> DataFrame:
    log = t.load(spark, folder, "events")
    return favorites.favorite(log, "event_type", "favorite_type", EVENTS)


@query
def events_temporal_split(spark: SparkSession, folder: str) -> DataFrame:
    log = t.load(spark, folder, "events").select("event_id", "user_id", "ts")
    return split.temporal_split(log, cols=EVENTS)


@query
def events_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return users.purchase_gap_events(t.load(spark, folder, "events"), EVENTS)
