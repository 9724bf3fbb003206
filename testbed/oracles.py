"""The queries as DuckDB SQL on the same files.

``PARTS`` holds named subqueries; ``sql`` prepends the ones a statement needs.
"""

from __future__ import annotations

import re

from testbed.tables import CODED, DOCUMENTS_PER_ARCHIVE
from trolley.columns import ARTICLES, CUSTOMERS, ITEM_CODES, ITEM_NUMERICS, TRANSACTIONS, USER_NUMERICS

PARTS: dict[str, str] = {}


def pad(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN length({text}) < 10 THEN lpad({text}, 10, '0') ELSE {text} END"


def vector_text(column: str) -> str:
    return (
        f"array_to_string(list_transform({column}, lambda x: "
        "CAST(round(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',')"
    )


def portable_hash(*columns: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(columns)})), 1, 15) AS BIGINT)"


def sql(statement: str) -> str:
    """The statement with the definitions of every part it uses, directly or through others."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+\b", text):
            if name in PARTS and name not in needed:
                visit(PARTS[name])
                if name not in needed:
                    needed.append(name)

    visit(statement)
    if not needed:
        return statement
    parts = ",\n".join(f"{name} AS ({PARTS[name]})" for name in needed)
    return f"WITH {parts}\n{statement}"


# --- raw tables ----------------------------------------------------------------------------

PARTS["tx_raw"] = """
SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL
            WHEN l_linenumber % 5 = 0 THEN '  C' || o_custkey || ' '
            ELSE 'c' || o_custkey END AS customer_id,
       l_partkey AS article_id, o_orderdate AS t_dat,
       CASE WHEN l_orderkey % 97 = 0 THEN -round(l_extendedprice * 100)
            WHEN l_orderkey % 89 = 0 THEN NULL
            ELSE round(l_extendedprice * 100) END AS price,
       l_orderkey % 2 + 1 AS sales_channel_id
FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

PARTS["cust_raw"] = """
SELECT CASE WHEN c_custkey % 3 = 0 THEN ' C' || c_custkey || ' ' ELSE 'c' || c_custkey END AS customer_id,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE CAST(c_custkey % 2 AS DOUBLE) END AS FN,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(1 AS DOUBLE) END AS Active,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE '  ' || c_mktsegment END AS club_member_status,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 'Regularly'
            ELSE ' NONE' END AS fashion_news_frequency,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_acctbal END AS age,
       'P' || c_nationkey AS postal_code
FROM customer"""

_coded = ",\n       ".join(
    f"p_partkey % {codes} AS {prefix}_{number}, '{prefix} ' || (p_partkey % {codes}) AS {prefix}_{name}"
    for prefix, number, name, codes in CODED
)
PARTS["art_raw"] = f"""
SELECT p_partkey AS article_id,
       CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_partkey // 10 END AS product_code,
       CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_name END AS prod_name,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size AS BIGINT) END AS product_type_no,
       'Type ' || p_size AS product_type_name,
       CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_type END AS product_group_name,
       p_partkey % 50 AS colour_group_code, p_brand AS colour_group_name,
       chr(CAST(65 + p_partkey % 10 AS INTEGER)) AS index_code,
       ' Index ' || chr(CAST(65 + p_partkey % 10 AS INTEGER)) AS index_name,
       {_coded},
       CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE ' Desc ' || p_name || ' ' END AS detail_desc
FROM part"""

PARTS["emb_raw"] = f"""
SELECT CAST(vec_id AS VARCHAR) AS article_id, embedding AS image_embedding,
       TIMESTAMP '2020-01-01' AS event_timestamp FROM embeddings
UNION ALL
SELECT {pad('vec_id')}, list_transform(embedding, lambda x: -x), TIMESTAMP '2020-06-01'
FROM embeddings WHERE vec_id % 5 = 0"""

# --- clean tables --------------------------------------------------------------------------

PARTS["tx"] = f"""
SELECT customer_id, article_id, t_dat, price, sales_channel_id, t_dat AS event_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, article_id, t_dat
                               ORDER BY price, sales_channel_id) AS rn
  FROM (SELECT trim(lower(customer_id)) AS customer_id, {pad('article_id')} AS article_id, t_dat,
               price, sales_channel_id FROM tx_raw)
  WHERE price > 0 AND customer_id IS NOT NULL AND article_id IS NOT NULL) WHERE rn = 1"""


def _text(*columns: str) -> str:
    return ", ".join(f"coalesce(trim(lower({c})), 'unknown') AS {c}" for c in columns)


def _median(table: str, *columns: str) -> str:
    return ", ".join(
        f"coalesce({c}, (SELECT quantile_disc({c}, 0.5) FROM {table})) AS {c}" for c in columns
    )


PARTS["cust"] = f"""
SELECT {_text('customer_id', 'club_member_status', 'fashion_news_frequency', 'postal_code')},
       {_median('cust_raw', 'FN', 'Active', 'age')} FROM cust_raw"""

ARTICLE_TEXT = (
    "prod_name",
    "product_type_name",
    "product_group_name",
    "colour_group_name",
    "index_code",
    "index_name",
    *[f"{prefix}_{name}" for prefix, _, name, _ in CODED],
    "detail_desc",
)
ARTICLE_NUMBERS = (
    "product_type_no",
    "colour_group_code",
    *[f"{prefix}_{number}" for prefix, number, _, _ in CODED],
)
PARTS["art"] = f"""
SELECT {pad('article_id')} AS article_id, product_code, {_text(*ARTICLE_TEXT)},
       {_median('art_raw', *ARTICLE_NUMBERS)} FROM art_raw"""

PARTS["emb"] = f"""
SELECT article_id, image_embedding FROM (
  SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY event_timestamp DESC) AS rn
  FROM (SELECT {pad('article_id')} AS article_id, image_embedding, event_timestamp FROM emb_raw))
WHERE rn = 1"""

PARTS["bought"] = """
SELECT tx.*, product_group_name, colour_group_name FROM tx LEFT JOIN art USING (article_id)"""

CALENDAR = """CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS day_of_week,
       CAST(month(event_timestamp) AS INTEGER) AS month, CAST(year(event_timestamp) AS INTEGER) AS year,
       CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""

PARTS["timed"] = f"SELECT *, {CALENDAR} FROM tx"


def favorite(table: str, column: str, name: str, user: str = "customer_id") -> str:
    return f"""
SELECT {user}, {column} AS {name} FROM (
  SELECT {user}, {column}, row_number() OVER (PARTITION BY {user}
         ORDER BY count(*) DESC, {column} ASC NULLS LAST) AS rn
  FROM {table} GROUP BY {user}, {column}) WHERE rn = 1"""


PARTS["fav_category"] = favorite("bought", "product_group_name", "favorite_category")
PARTS["fav_color"] = favorite("bought", "colour_group_name", "favorite_color")
PARTS["fav_channel"] = favorite("tx", "sales_channel_id", "preferred_channel")
PARTS["fav_day"] = favorite("timed", "day_of_week", "day_of_week")
PARTS["fav_month"] = favorite("timed", "month", "month")

PARTS["cust_feat"] = """
SELECT b.*, favorite_category FROM (
  SELECT customer_id, count(*) AS purchase_count, avg(price) AS avg_spend, max(t_dat) AS last_purchase
  FROM tx GROUP BY customer_id) b JOIN fav_category USING (customer_id)"""

PARTS["popular"] = """
SELECT article_id, count(*) AS item_purchase_count, count(DISTINCT customer_id) AS unique_buyers,
       avg(price) AS avg_item_price FROM tx GROUP BY article_id"""

PARTS["wide_two_tower"] = f"""
SELECT tx.*, cust.* EXCLUDE (customer_id), art.* EXCLUDE (article_id), {CALENDAR},
       purchase_count, avg_spend, favorite_category, last_purchase,
       item_purchase_count, unique_buyers, avg_item_price, favorite_color
FROM tx LEFT JOIN cust USING (customer_id) LEFT JOIN art USING (article_id)
LEFT JOIN cust_feat USING (customer_id) LEFT JOIN popular USING (article_id)
LEFT JOIN fav_color USING (customer_id)"""

PARTS["user_stat"] = """
SELECT customer_id, avg(price) AS user_avg_price, count(*) AS user_total_interactions,
       count(DISTINCT product_group_name) AS user_category_diversity,
       max(event_timestamp) AS last_purchase_ts FROM bought GROUP BY customer_id"""
PARTS["item_stat"] = """
SELECT article_id, count(*) AS item_popularity, avg(price) AS item_avg_price,
       count(DISTINCT customer_id) AS unique_buyers FROM tx GROUP BY article_id"""

PARTS["gaps"] = """
SELECT customer_id, article_id, event_timestamp, lag(event_timestamp) OVER (
         PARTITION BY customer_id ORDER BY event_timestamp, article_id) AS previous_purchase FROM tx"""
PARTS["user_gap"] = """
SELECT customer_id, avg(date_diff('day', previous_purchase, event_timestamp)) AS avg_purchase_gap_days
FROM gaps GROUP BY customer_id"""

PARTS["user_feat"] = """
SELECT b.*, preferred_channel, favorite_category, favorite_color, avg_purchase_gap_days FROM (
  SELECT customer_id, count(*) AS purchase_count, avg(price) AS avg_spend,
         avg(CASE WHEN dayofweek(event_timestamp) IN (0, 6) THEN 1 ELSE 0 END) AS weekend_ratio,
         count(DISTINCT product_group_name) AS category_diversity
  FROM bought GROUP BY customer_id) b
JOIN fav_channel USING (customer_id) JOIN fav_category USING (customer_id)
JOIN fav_color USING (customer_id) JOIN user_gap USING (customer_id)"""

PARTS["item_feat"] = f"""
SELECT i.* EXCLUDE (last_sale), image_embedding,
       CAST(date_diff('day', last_sale, (SELECT max(event_timestamp) FROM tx)) AS INTEGER)
         AS days_since_last_sale,
       CASE WHEN image_embedding IS NULL THEN 0 ELSE 1 END AS embedding_available
FROM (SELECT article_id, count(*) AS item_purchase_count,
             count(DISTINCT customer_id) AS unique_buyers, avg(price) AS avg_item_price,
             {', '.join(f'min({c}) AS {c}' for c in ITEM_CODES)}, max(event_timestamp) AS last_sale
      FROM tx LEFT JOIN art USING (article_id) GROUP BY article_id) i
LEFT JOIN emb USING (article_id)"""


def split_parts(name: str, table: str, time: str, first: float, second: float) -> None:
    """Parts with the cut times of a log and the log with its split column."""
    span = f"epoch_us(max({time})) - epoch_us(min({time}))"

    def cut(share: float) -> str:
        return f"make_timestamp(CAST(epoch_us(min({time})) + floor(({span}) * CAST({share} AS DOUBLE)) AS BIGINT))"

    PARTS[f"{name}_cuts"] = f"SELECT {cut(first)} AS low, {cut(second)} AS high FROM {table}"
    PARTS[f"{name}_split"] = f"""
SELECT {table}.*, CASE WHEN {time} < low THEN 'train' WHEN {time} < high THEN 'validation'
       ELSE 'test' END AS split FROM {table}, {name}_cuts WHERE {time} IS NOT NULL"""


split_parts("log", "tx", "event_timestamp", 0.8, 0.9)
PARTS["event_log"] = "SELECT event_id, user_id, ts FROM events"
split_parts("event", "event_log", "ts", 0.8, 0.9)

# --- training sets -------------------------------------------------------------------------


def dense(table: str, key: str, index: str, start: int = 0) -> str:
    return f"""
SELECT {key}, row_number() OVER (ORDER BY {key}) - 1 + {start} AS {index}
FROM (SELECT DISTINCT {key} FROM {table} WHERE {key} IS NOT NULL)"""


PARTS["user_idx"] = dense("tx", "customer_id", "customer_idx")
PARTS["item_idx"] = dense("tx", "article_id", "article_idx")
PARTS["usable"] = "SELECT article_id FROM tx SEMI JOIN emb USING (article_id)"
PARTS["usable_idx"] = dense("usable", "article_id", "article_idx")

PARTS["drawn"] = f"""
SELECT customer_id, article_id AS bought_id,
       {portable_hash('customer_id', 'article_id', 't_dat', 'draw', '42')}
         % (SELECT count(*) FROM usable_idx) AS article_idx
FROM tx, (SELECT unnest([1, 2, 3]) AS draw)"""
PARTS["negatives"] = """
SELECT d.customer_id, u.article_id, 0 AS label FROM drawn d JOIN usable_idx u USING (article_idx)
WHERE NOT EXISTS (SELECT 1 FROM tx WHERE tx.customer_id = d.customer_id AND tx.article_id = u.article_id)"""

PARTS["ranking_rows"] = f"""
SELECT s.*, purchase_count, avg_spend, item_purchase_count, unique_buyers, avg_item_price,
       {vector_text('image_embedding')} AS image_embedding,
       {portable_hash('customer_id', 'article_id', 'label', '42')} AS shuffle_key
FROM (SELECT customer_id, article_id, 1 AS label FROM tx
      UNION ALL SELECT * FROM negatives) s
JOIN emb USING (article_id) JOIN popular USING (article_id)
JOIN (SELECT customer_id, purchase_count, avg_spend FROM cust_feat) USING (customer_id)"""

# --- vectors -------------------------------------------------------------------------------

PARTS["user_vec"] = """
SELECT 'c' || c_custkey AS customer_id, embedding FROM customer
JOIN embeddings ON vec_id = c_custkey % (SELECT count(*) FROM embeddings)"""

PARTS["candidates"] = """
SELECT customer_id, article_id, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT customer_id, article_id, score,
         row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) AS rank
  FROM (SELECT customer_id, article_id,
               round(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(image_embedding AS DOUBLE[])), 6)
                 AS score FROM user_vec, emb)) WHERE rank <= 100"""

PARTS["reranked"] = """
SELECT customer_id, article_id, retrieval_score, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY score DESC, article_id) AS rank
  FROM (SELECT customer_id, article_id, c.score AS retrieval_score,
               c.score + coalesce(item_purchase_count, 0) / CAST(100 AS DOUBLE) AS score
        FROM candidates c LEFT JOIN popular USING (article_id))) WHERE rank <= 10"""

PARTS["recs"] = """
SELECT customer_id, rank, article_id, score, 'popularity' AS method FROM reranked
UNION ALL
SELECT customer_id, rank, article_id, score, 'vector' FROM candidates WHERE rank <= 10"""

SIMPLE_TEXT = ("customer_id", "club_member_status", "fashion_news_frequency", "postal_code")


def _value_counts(table: str, columns: tuple[str, ...]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS value, count(*) AS count "
        f"FROM {table} GROUP BY {c}"
        for c in columns
    )


def _categorical(table: str, columns: tuple[str, ...]) -> str:
    return f"""
SELECT feature, value, count, CAST(rank AS INTEGER) AS rank, unique_count FROM (
  SELECT *, row_number() OVER (PARTITION BY feature ORDER BY count DESC, value NULLS FIRST) AS rank,
         count(*) OVER (PARTITION BY feature) AS unique_count
  FROM ({_value_counts(table, columns)})) WHERE rank <= 10"""


def _numeric(table: str, column: str, dtype: str) -> str:
    cuts = ", ".join(
        f"CAST(quantile_disc({column}, {p}) AS DOUBLE) AS p{round(p * 100):02d}"
        for p in (0.01, 0.05, 0.25, 0.50, 0.75, 0.95, 0.99)
    )
    return (
        f"SELECT '{column}' AS feature, '{dtype}' AS dtype, count({column}) AS count, "
        f"count(*) - count({column}) AS null_count, CAST(min({column}) AS DOUBLE) AS min, "
        f"CAST(max({column}) AS DOUBLE) AS max, avg({column}) AS mean, "
        f"round(stddev_samp({column}), 3) AS std, {cuts} FROM {table}"
    )


PARTS["feat_text"] = "SELECT customer_id, favorite_category FROM cust_feat"
_feature_columns = ("customer_id", "favorite_category")
_numeric_columns = ("purchase_count", "avg_spend")


def _tidy_numbers(column: str, dtype: str) -> str:
    """The numeric row of a column as a row for each statistic, fractions as text of thousandths."""
    plain = ("dtype", "count", "null_count")
    real = ("min", "max", "mean", "std", "p01", "p05", "p25", "p50", "p75", "p95", "p99")
    texts = [f"SELECT feature, '{c}' AS stat, CAST({c} AS VARCHAR) AS value FROM n" for c in plain]
    texts += [f"SELECT feature, '{c}', CAST(CAST(round({c}, 3) AS DECIMAL(30, 3)) AS VARCHAR) FROM n" for c in real]
    return f"WITH n AS ({_numeric('cust_feat', column, dtype)}) " + " UNION ALL ".join(texts)


def _row_digest(table: str, columns: tuple[str, ...], cents: tuple[str, ...] = ()) -> str:
    """A digest of each row's cells, numbers with fractions as hundredths."""
    cells = [f"CAST(CAST(round({c} * 100) AS BIGINT) AS VARCHAR)" if c in cents else f"CAST({c} AS VARCHAR)" for c in columns]
    text = " || '|' || ".join(f"coalesce({c}, '-')" for c in cells)
    return f"SELECT '{table}' AS table_name, md5({text}) AS cells"

ORACLES: dict[str, str] = {
    # sources and sinks
    "src_raw_tables": " UNION ALL ".join(
        (
            _row_digest("articles", tuple(ARTICLES.names)) + " FROM art_raw",
            _row_digest("customers", tuple(CUSTOMERS.names), ("FN", "Active", "age")) + " FROM cust_raw",
            _row_digest("transactions", tuple(TRANSACTIONS.names), ("price",)) + " FROM tx_raw",
        )
    ),
    "src_normalized_ids": f"SELECT customer_id, {pad('article_id')} AS article_id, t_dat FROM tx_raw",
    "src_projected": "SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem",
    "sink_roundtrip": "SELECT * FROM tx",
    "sink_replace_partitions": """
        SELECT * REPLACE (CASE WHEN sales_channel_id = 2 THEN price * 2 ELSE price END AS price) FROM tx""",
    "chunked_scan": "SELECT * FROM timed",
    # cleaning
    "clean_transactions": "SELECT * FROM tx",
    "clean_customers": "SELECT * FROM cust",
    "clean_articles": "SELECT * FROM art",
    "dedup_transactions": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
          PARTITION BY customer_id, article_id, t_dat
          ORDER BY price NULLS FIRST, sales_channel_id) AS rn FROM tx_raw) WHERE rn = 1""",
    "normalize_strings": "SELECT FN, Active, age, "
    + ", ".join(f"trim(lower({c})) AS {c}" for c in SIMPLE_TEXT)
    + " FROM cust_raw",
    "impute_median": f"SELECT article_id, {_median('art_raw', 'product_type_no', 'section_no')} FROM art_raw",
    "impute_constant": """
        SELECT coalesce(customer_id, 'unknown') AS customer_id,
               coalesce(club_member_status, 'UNKNOWN') AS club_member_status,
               coalesce(fashion_news_frequency, 'UNKNOWN') AS fashion_news_frequency,
               coalesce(postal_code, 'unknown') AS postal_code FROM cust_raw""",
    # joins and wide tables
    "star_join": """
        SELECT tx.*, cust.* EXCLUDE (customer_id), art.* EXCLUDE (article_id)
        FROM tx LEFT JOIN cust USING (customer_id) LEFT JOIN art USING (article_id)""",
    "temporal_features": "SELECT * FROM timed",
    "favorite_category": "SELECT * FROM fav_category",
    "favorite_color": "SELECT * FROM fav_color",
    "preferred_channel": "SELECT * FROM fav_channel",
    "customer_features": "SELECT * FROM cust_feat",
    "item_popularity": "SELECT * FROM popular",
    "purchase_recency": """
        SELECT *, CAST(date_diff('day', event_timestamp, last_purchase_ts) AS INTEGER)
                    AS days_since_last_purchase
        FROM (SELECT *, max(event_timestamp) OVER (PARTITION BY customer_id) AS last_purchase_ts FROM tx)""",
    "ranking_interactions": f"""
        SELECT tx.*, cust.* EXCLUDE (customer_id), art.* EXCLUDE (article_id), {CALENDAR},
               user_avg_price, user_total_interactions, user_category_diversity,
               item_popularity, item_avg_price, unique_buyers,
               abs(user_avg_price - price) AS price_affinity,
               item_popularity * price AS popularity_price_score, last_purchase_ts,
               CAST(date_diff('day', event_timestamp, last_purchase_ts) AS INTEGER)
                 AS days_since_last_purchase, 1 AS label
        FROM tx LEFT JOIN cust USING (customer_id) LEFT JOIN art USING (article_id)
        LEFT JOIN user_stat USING (customer_id) LEFT JOIN item_stat USING (article_id)""",
    "two_tower_interactions": "SELECT * FROM wide_two_tower",
    "ranking_interactions_as_of": f"""
        WITH known AS (SELECT * FROM bought WHERE event_timestamp < TIMESTAMP '2000-01-01'),
        user_known AS (
          SELECT customer_id, avg(price) AS user_avg_price, count(*) AS user_total_interactions,
                 count(DISTINCT product_group_name) AS user_category_diversity,
                 max(event_timestamp) AS last_purchase_ts FROM known GROUP BY customer_id),
        item_known AS (
          SELECT article_id, count(*) AS item_popularity, avg(price) AS item_avg_price,
                 count(DISTINCT customer_id) AS unique_buyers FROM known GROUP BY article_id)
        SELECT tx.*, cust.* EXCLUDE (customer_id), art.* EXCLUDE (article_id), {CALENDAR},
               user_avg_price, user_total_interactions, user_category_diversity,
               item_popularity, item_avg_price, unique_buyers,
               abs(user_avg_price - price) AS price_affinity,
               item_popularity * price AS popularity_price_score, last_purchase_ts,
               CAST(date_diff('day', event_timestamp, last_purchase_ts) AS INTEGER)
                 AS days_since_last_purchase, 1 AS label
        FROM tx LEFT JOIN cust USING (customer_id) LEFT JOIN art USING (article_id)
        LEFT JOIN user_known USING (customer_id) LEFT JOIN item_known USING (article_id)
        WHERE event_timestamp >= TIMESTAMP '2000-01-01'""",
    "customer_sales_summary": """
        SELECT customer_id, sum(price) AS total_sales, avg(price) AS avg_sales, count(price) AS total_orders
        FROM tx JOIN cust USING (customer_id) GROUP BY customer_id""",
    # split, feature tables, statistics
    "temporal_split": "SELECT * FROM log_split",
    "split_metadata": """
        SELECT 'test' AS environment, count(*) FILTER (split = 'train') AS train_rows,
               count(*) FILTER (split = 'validation') AS validation_rows,
               count(*) FILTER (split = 'test') AS test_rows,
               64 AS embedding_dimension, 42 AS random_seed FROM log_split""",
    "split_metadata_written": """
        SELECT 'test' AS environment, count(*) FILTER (split = 'train') AS train_rows,
               count(*) FILTER (split = 'validation') AS validation_rows,
               count(*) FILTER (split = 'test') AS test_rows,
               64 AS embedding_dimension, 42 AS random_seed FROM log_split""",
    "table_shapes_written": f"""
        SELECT 'transactions' AS dataset, count(*) AS row_count, {len(TRANSACTIONS.names) + 1} AS column_count FROM tx
        UNION ALL SELECT 'customers', count(*), {len(CUSTOMERS.names)} FROM cust
        UNION ALL SELECT 'articles', count(*), {len(ARTICLES.names)} FROM art""",
    "hash_split": f"""
        SELECT customer_id, article_id, t_dat,
               CASE WHEN {portable_hash('customer_id', 'article_id', 't_dat', '42')} % 100 < 20
                    THEN 'test' ELSE 'train' END AS split FROM tx""",
    "dedup_embeddings": f"SELECT article_id, {vector_text('image_embedding')} AS vector FROM emb",
    "purchase_gap": "SELECT * FROM user_gap",
    "purchase_gap_events": """
        SELECT *, CAST(date_diff('day', previous_purchase, event_timestamp) AS INTEGER) AS gap_days
        FROM gaps""",
    "user_features": "SELECT * FROM user_feat",
    "item_features": f"""
        SELECT * REPLACE ({vector_text('image_embedding')} AS image_embedding) FROM item_feat""",
    "ranking_features": f"""
        SELECT customer_id, article_id, embedding_available, purchase_count, avg_spend,
               category_diversity, avg_purchase_gap_days, item_purchase_count, avg_item_price,
               days_since_last_sale,
               CASE WHEN avg_spend > 0 THEN avg_item_price / avg_spend ELSE 0 END AS price_affinity,
               sales_channel_id, day_of_week, month, is_weekend
        FROM (SELECT customer_id, article_id, sales_channel_id, {CALENDAR} FROM tx)
        JOIN user_feat USING (customer_id) JOIN item_feat USING (article_id)""",
    "stats_numeric": " UNION ALL ".join(
        _numeric("timed", column, dtype)
        for column, dtype in (
            ("price", "double"),
            ("sales_channel_id", "bigint"),
            ("day_of_week", "int"),
            ("month", "int"),
            ("year", "int"),
            ("is_weekend", "int"),
        )
    ),
    "stats_categorical": _categorical(
        "bought", ("customer_id", "product_group_name", "colour_group_name")
    ),
    "stats_embedding": """
        SELECT 'image_embedding' AS feature, 'array<float>' AS dtype, count(*) AS count,
               count(*) - count(image_embedding) AS null_count,
               avg(len(image_embedding)) AS avg_dimension FROM item_feat""",
    "embedding_coverage": "SELECT avg(embedding_available) AS coverage_ratio FROM item_feat",
    "fit_ranker": f"""
        SELECT count(*) FILTER (label = 1) AS positives, count(*) FILTER (label = 0) AS negatives,
               CAST(1 AS INTEGER) AS better_than_chance
        FROM ranking_rows WHERE {portable_hash('shuffle_key', '42')} % 100 < 20""",
    "fit_retrieval": """
        SELECT count(DISTINCT customer_id) AS customers, CAST(10 AS BIGINT) AS fewest, CAST(10 AS BIGINT) AS most,
               CAST(1 AS INTEGER) AS better_than_popular FROM tx""",
    "fit_wide_ranker": """
        SELECT count(*) FILTER (price > mean) AS positives, count(*) FILTER (price <= mean) AS negatives,
               CAST(1 AS INTEGER) AS better_than_chance
        FROM (SELECT price, t_dat, avg(price) OVER (PARTITION BY customer_id) AS mean FROM tx)
        WHERE (year(t_dat) * 12 + month(t_dat)) % 5 = 0""",
    "feature_statistics": f"""
        SELECT 'customer_features' AS dataset, * FROM (
        SELECT 'table' AS kind, 'customer_features' AS feature, 'row_count' AS stat,
               CAST(count(*) AS VARCHAR) AS value FROM cust_feat
        UNION ALL SELECT 'table', 'customer_features', 'column_count', '5'
        UNION ALL SELECT 'categorical', feature, 'unique_count', CAST(count(*) AS VARCHAR)
          FROM ({_value_counts('feat_text', _feature_columns)}) GROUP BY feature
        UNION ALL SELECT 'top_value', feature, coalesce(value, 'None'), CAST(count AS VARCHAR)
          FROM ({_categorical('feat_text', _feature_columns)})
        """
    + " ".join(
        f"UNION ALL SELECT 'numeric', feature, stat, value FROM ({_tidy_numbers(c, dtype)})"
        for c, dtype in zip(_numeric_columns, ("bigint", "double"), strict=True)
    )
    + ")",
    "stats_of_chunks": " UNION ALL ".join(
        [
            f"SELECT '{c}' AS feature, count({c}) AS count, count(*) - count({c}) AS null_count, "
            f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 3) AS mean, "
            f"round(stddev_samp({c}), 3) AS std, 1 AS percentiles_close, 1 AS distinct_close FROM timed"
            for c in ("price", "sales_channel_id", "day_of_week", "month", "year", "is_weekend")
        ]
        + [
            f"SELECT '{c}', count({c}), count(*) - count({c}), NULL, NULL, NULL, NULL, NULL, 1 FROM timed"
            for c in ("customer_id", "article_id")
        ]
    ),
    "dataset_profile": """
        SELECT 'transactions' AS dataset_name, count(*) AS rows, 6 AS columns,
               count(DISTINCT customer_id) AS unique_customers,
               count(DISTINCT article_id) AS unique_articles,
               min(event_timestamp) AS min_timestamp, max(event_timestamp) AS max_timestamp,
               CAST(NULL AS INTEGER) AS embedding_dimension FROM tx
        UNION ALL
        SELECT 'embeddings', count(*), 3, NULL, count(DISTINCT article_id), min(event_timestamp),
               max(event_timestamp), CAST(max(len(image_embedding)) AS INTEGER) FROM emb_raw""",
    "column_cardinality": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) AS unique_count FROM (SELECT DISTINCT {c} FROM art_raw)"
        for c in (*ARTICLE_TEXT, *ARTICLE_NUMBERS)
    ),
    "null_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count(*) - count({c}) AS null_count, "
        f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS null_share FROM cust_raw"
        for c in (*SIMPLE_TEXT, "FN", "Active", "age")
    ),
    "user_mode_features": """
        SELECT customer_id, purchase_count, avg_spend, day_of_week, month, is_weekend,
               favorite_category, favorite_color
        FROM (SELECT customer_id, avg(is_weekend) AS is_weekend FROM timed GROUP BY customer_id)
        JOIN cust_feat USING (customer_id) JOIN fav_color USING (customer_id)
        JOIN fav_day USING (customer_id) JOIN fav_month USING (customer_id)""",
    # training sets
    "user_index": "SELECT * FROM user_idx",
    "item_index": "SELECT * FROM item_idx",
    "vocab_category": dense("fav_category", "favorite_category", "favorite_category_idx", 1),
    "vocab_color": dense("fav_color", "favorite_color", "favorite_color_idx", 1),
    "align_items": f"""
        SELECT popular.*, {vector_text('image_embedding')} AS image_embedding
        FROM popular JOIN emb USING (article_id)""",
    "encode_user_matrix": "SELECT customer_id, "
    + ", ".join(f"coalesce(CAST({c} AS FLOAT), 0) AS {c}" for c in USER_NUMERICS)
    + " FROM user_feat",
    "encode_item_matrix": "SELECT article_id, "
    + ", ".join(f"coalesce(CAST({c} AS FLOAT), 0) AS {c}" for c in ITEM_NUMERICS)
    + ", "
    + ", ".join(f"coalesce(CAST({c} AS INTEGER), -1) AS {c}" for c in ITEM_CODES)
    + " FROM item_feat",
    "encode_categories": f"""
        WITH seen AS (SELECT * FROM bought WHERE product_group_name NOT LIKE 'promo%' AND colour_group_name <> 'brand#11'),
             seen_category AS ({favorite('seen', 'product_group_name', 'favorite_category')}),
             seen_color AS ({favorite('seen', 'colour_group_name', 'favorite_color')}),
             known_category AS ({dense('seen_category', 'favorite_category', 'favorite_category_idx', 1)}),
             known_color AS ({dense('seen_color', 'favorite_color', 'favorite_color_idx', 1)})
        SELECT customer_id, favorite_category, favorite_color,
               coalesce(favorite_category_idx, 0) AS favorite_category_idx,
               coalesce(favorite_color_idx, 0) AS favorite_color_idx
        FROM fav_category JOIN fav_color USING (customer_id)
        LEFT JOIN known_category USING (favorite_category) LEFT JOIN known_color USING (favorite_color)""",
    "negative_samples": "SELECT * FROM negatives",
    "ranking_dataset": "SELECT * FROM ranking_rows",
    "label_balance": """
        SELECT label, count(*) AS rows, count(*) / sum(count(*)) OVER () AS share
        FROM ranking_rows GROUP BY label""",
    "two_tower_dataset": f"""
        SELECT tx.*, article_idx, customer_idx, {vector_text('image_embedding')} AS image_embedding
        FROM tx JOIN item_idx USING (article_id) JOIN emb USING (article_id)
        JOIN user_idx USING (customer_id)""",
    "ranking_chunks": "SELECT * FROM ranking_rows",
    "two_tower_chunks": f"""
        SELECT tx.*, article_idx, customer_idx, {vector_text('image_embedding')} AS image_embedding
        FROM tx JOIN item_idx USING (article_id) JOIN emb USING (article_id)
        JOIN user_idx USING (customer_id)""",
    "retrieval_dataset": f"""
        SELECT customer_id, article_id, t_dat,
               {vector_text('[CAST(purchase_count AS FLOAT), CAST(avg_spend AS FLOAT)]')} AS user_numeric,
               favorite_category AS user_category, favorite_color AS user_color,
               {vector_text('[CAST(item_purchase_count AS FLOAT), CAST(unique_buyers AS FLOAT), CAST(avg_item_price AS FLOAT)]')}
                 AS item_numeric,
               {vector_text('[' + ', '.join(ITEM_CODES) + ']')} AS item_categorical,
               {vector_text('image_embedding')} AS image_embedding
        FROM wide_two_tower JOIN emb USING (article_id)""",
    "standard_scale": """
        WITH summary AS (SELECT customer_id, count(*) AS purchase_count, avg(price) AS avg_spend,
                                avg(is_weekend) AS is_weekend FROM timed GROUP BY customer_id)
        SELECT customer_id, """
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM summary)) / (SELECT stddev_pop({c}) FROM summary), 6) AS {c}"
        for c in ("purchase_count", "avg_spend", "is_weekend")
    )
    + " FROM summary",
    "minmax_scale": """
        SELECT customer_id, article_id, t_dat, round((price - low) / (high - low), 9) AS price, split
        FROM log_split, (SELECT min(price) AS low, max(price) AS high FROM log_split WHERE split = 'train')""",
    "drop_outliers": """
        SELECT customer_id, article_id, t_dat, price, split
        FROM log_split, (SELECT avg(price) AS mean, stddev_pop(price) AS std FROM log_split WHERE split = 'train')
        WHERE price BETWEEN mean - 1.5 * std AND mean + 1.5 * std""",
    "impute_mean": """
        SELECT customer_id, round(coalesce(age, (SELECT avg(age) FROM cust_raw WHERE customer_id NOT LIKE ' %')), 6) AS age,
               round(coalesce(FN, (SELECT avg(FN) FROM cust_raw WHERE customer_id NOT LIKE ' %')), 6) AS FN
        FROM cust_raw""",
    "fit_cold_items": f"""
        SELECT article_id, CAST(8 AS INTEGER) AS dimension, CAST(1 AS INTEGER) AS finite FROM emb JOIN art USING (article_id)
        WHERE {portable_hash('article_id', '42')} % 100 < 20""",
    "assemble_vector": f"""
        WITH both_sides AS (SELECT * FROM popular JOIN emb USING (article_id)),
             per_position AS (
               SELECT position, avg(value) AS mean, stddev_pop(value) AS std FROM (
                 SELECT CAST(unnest(image_embedding) AS DOUBLE) AS value,
                        unnest(range(len(image_embedding))) AS position FROM both_sides)
               GROUP BY position),
             scaled AS (
               SELECT article_id, list((value - mean) / std ORDER BY position) AS vector FROM (
                 SELECT article_id, CAST(unnest(image_embedding) AS DOUBLE) AS value,
                        unnest(range(len(image_embedding))) AS position FROM both_sides)
               JOIN per_position USING (position) GROUP BY article_id),
             numbers AS (
               SELECT article_id, ["""
    + ", ".join(
        f"({c} - (SELECT avg({c}) FROM both_sides)) / (SELECT stddev_pop({c}) FROM both_sides)"
        for c in ("item_purchase_count", "unique_buyers", "avg_item_price")
    )
    + f"""] AS head FROM both_sides)
        SELECT article_id, {vector_text('list_concat(head, vector)')} AS features,
               CASE WHEN {portable_hash('article_id', '42')} % 100 < 20 THEN 'test' ELSE 'train' END AS split
        FROM numbers JOIN scaled USING (article_id)""",
    "finite_or_zero": """
        SELECT l_orderkey, l_partkey, l_linenumber,
               CASE WHEN l_linenumber % 2 = 0 OR l_linenumber % 3 = 0 OR l_linenumber % 5 = 0
                      OR l_linenumber % 7 = 0 THEN 0 ELSE l_extendedprice END AS value FROM lineitem""",
    # vectors and recommendations
    "vec_l2_normalize": """
        SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS position,
               round(unnest(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))
                     / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6)
                 AS value FROM embeddings""",
    "vec_parse": f"""
        SELECT vec_id, CASE WHEN vec_id % 7 = 0
                 THEN array_to_string(list_transform(embedding, lambda x: 0), ',')
                 ELSE {vector_text('embedding')} END AS vector FROM embeddings""",
    "vec_pair_scores": """
        SELECT a.vec_id,
               round(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS dot,
               round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6)
                 AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
    "vec_topk": "SELECT * FROM candidates",
    "vec_ivf_topk": "SELECT * FROM candidates",
    "vec_bounded_topk": "SELECT * FROM candidates",
    "vec_ivf_recall": """
        SELECT count(DISTINCT customer_id) AS customers, count(*) AS true_rows, 1 AS recall_reached FROM candidates""",
    "vec_bounded_clustered": """
        WITH clustered AS (
          SELECT vec_id, list_transform(embedding, lambda x, i: CAST(CAST(
                   CAST(x AS DOUBLE) * CAST(0.2 AS DOUBLE) + CASE WHEN i = label + 1 THEN CAST(3 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                 AS FLOAT) AS DOUBLE)) AS vector FROM embeddings)
        SELECT query_id, vec_id, score, CAST(rank AS INTEGER) AS rank FROM (
          SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
          FROM (SELECT q.vec_id AS query_id, i.vec_id, round(list_inner_product(q.vector, i.vector), 6) AS score
                FROM clustered q, clustered i)) WHERE rank <= 10""",
    "vec_bounded_pairs": """
        SELECT count(*) AS items, count(*) * count(*) AS all_pairs, 1 AS half_at_most FROM embeddings""",
    "batch_recommendations_bounded": "SELECT * FROM recs WHERE method = 'popularity'",
    "vec_cosine_topk": """
        SELECT query_id, article_id, score, CAST(rank AS INTEGER) AS rank FROM (
          SELECT query_id, article_id, score,
                 row_number() OVER (PARTITION BY query_id ORDER BY score DESC, article_id) AS rank
          FROM (SELECT q.article_id AS query_id, i.article_id,
                       round(list_cosine_similarity(CAST(q.image_embedding AS DOUBLE[]),
                                                    CAST(i.image_embedding AS DOUBLE[])), 6) AS score
                FROM emb q, emb i)) WHERE rank <= 10""",
    "rerank_topk": "SELECT * FROM reranked",
    "batch_recommendations": "SELECT * FROM recs WHERE method = 'popularity'",
    "rec_summary": """
        SELECT method, count(DISTINCT customer_id) AS users, count(*) AS recommendations,
               round(avg(score), 4) AS avg_score, round(stddev_samp(score), 4) AS std_score,
               round(avg(score) FILTER (rank = 1), 4) AS avg_top_score FROM recs GROUP BY method""",
    "vec_export_batches": f"""
        SELECT (row_number() OVER (ORDER BY article_id) - 1) // 100 AS batch_no, article_id AS id,
               {vector_text('image_embedding')} AS vector, item_purchase_count AS popularity,
               'product' AS type FROM popular JOIN emb USING (article_id)""",
    "vec_export_sink": f"""
        SELECT (row_number() OVER (ORDER BY article_id) - 1) // 100 AS batch_no, article_id AS id,
               {vector_text('image_embedding')} AS vector, item_purchase_count AS popularity,
               'product' AS type FROM popular JOIN emb USING (article_id)""",
    # metrics
    "binary_metrics": """
        WITH scored AS (
          SELECT ((l_partkey * 7919 + l_orderkey * 104729) % 10007) / CAST(10007 AS DOUBLE) AS score,
                 CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem),
        placed AS (
          SELECT *, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / CAST(2 AS DOUBLE)
                      AS mid_rank FROM scored),
        sums AS (
          SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(sum(1 - label) AS BIGINT) AS negatives,
                 count(*) FILTER (label = 1 AND score > 0.5) AS tp,
                 count(*) FILTER (label = 0 AND score > 0.5) AS fp,
                 sum(mid_rank) FILTER (label = 1) AS rank_sum FROM placed)
        SELECT positives, negatives,
               round((tp + negatives - fp) / CAST(positives + negatives AS DOUBLE), 9) AS accuracy,
               round(tp / CAST(tp + fp AS DOUBLE), 9) AS precision,
               round(tp / CAST(positives AS DOUBLE), 9) AS recall,
               round((rank_sum - positives * (positives + 1) / CAST(2 AS DOUBLE))
                     / (CAST(positives AS DOUBLE) * negatives), 9) AS auc FROM sums""",
    # images
    "img_zip_members": f"""
        SELECT 'archive_' || (doc_id // {DOCUMENTS_PER_ARCHIVE}) || '.zip' AS archive,
               lpad(CAST(doc_id AS VARCHAR), 10, '0') || '.jpg' AS member, strlen(text) AS size
        FROM documents""",
    "img_embed_job": f"""
        WITH counted AS (
          SELECT doc_id, [CAST(1 AS DOUBLE), {', '.join(
              f"CAST(length(text) - length(replace(text, '{c}', '')) AS DOUBLE)" for c in 'aein')}] AS v
          FROM documents WHERE strlen(text) % 13 <> 0),
        unit AS (
          SELECT doc_id, list_transform(v, lambda x: CAST(x / sqrt(list_sum(list_transform(v, lambda y: y * y))) AS FLOAT))
                   AS image_embedding FROM counted)
        SELECT lpad(CAST(doc_id AS VARCHAR), 10, '0') AS article_id,
               {vector_text('image_embedding')} AS image_embedding,
               TIMESTAMP '2020-01-01' AS event_timestamp FROM unit""",
    "img_embed_report": f"""
        SELECT 'archive_' || (doc_id // {DOCUMENTS_PER_ARCHIVE}) || '.zip' AS archive,
               count(*) FILTER (strlen(text) % 13 <> 0) AS embedded,
               count(*) FILTER (strlen(text) % 13 = 0) AS failed FROM documents GROUP BY 1""",
    "img_broken_archives": f"""
        SELECT 'archive_' || (doc_id // {DOCUMENTS_PER_ARCHIVE}) || '.zip' AS archive,
               count(*) FILTER (strlen(text) % 13 <> 0) AS embedded,
               count(*) FILTER (strlen(text) % 13 = 0) AS failed FROM documents GROUP BY 1
        UNION ALL
        SELECT DISTINCT 'cut_' || (doc_id // {DOCUMENTS_PER_ARCHIVE}) || '.zip', 0, 1 FROM documents
        WHERE doc_id // {DOCUMENTS_PER_ARCHIVE} < 2""",
    # the same operators on another log
    "events_favorite_type": favorite("events", "event_type", "favorite_type", "user_id"),
    "events_temporal_split": "SELECT * FROM event_split",
    "events_gaps": """
        SELECT *, CAST(date_diff('day', previous_purchase, ts) AS INTEGER) AS gap_days FROM (
          SELECT user_id, event_type, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_type)
                   AS previous_purchase FROM events)""",
}


def _merge_with(statement: str) -> str:
    """Put the needed parts in front of a statement that has definitions of its own."""
    full = sql(statement)
    own = re.search(r"\n\s*WITH ", full)
    if full.startswith("WITH ") and own:
        return full[: own.start()] + ",\n" + full[own.end() :]
    return full


def oracle_statements() -> dict[str, str]:
    return {name: _merge_with(statement) for name, statement in ORACLES.items()}
