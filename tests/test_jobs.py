import json

from pyspark.sql import functions as F

from testbed import tables as t
from trolley.__main__ import main
from trolley.plans.training_sets import ranking_chunks_job, two_tower_chunks_job
from trolley.sources.tables import Catalog
from trolley.streaming.chunks import process_chunks


def test_command_line_from_raw_tables_to_training_sets(spark, small, tmp_path):
    raw, etl, features, sets = (str(tmp_path / n) for n in ("raw", "etl", "features", "sets"))
    t.raw_articles(spark, small).write.parquet(f"{raw}/articles.parquet")
    t.raw_customers(spark, small).write.parquet(f"{raw}/customers.parquet")
    t.raw_transactions(spark, small).write.parquet(f"{raw}/transactions.parquet")
    t.raw_embeddings(spark, small).write.parquet(f"{tmp_path}/vectors")

    main(["etl", "--raw", raw, "--output", etl])
    wide = spark.read.parquet(f"{etl}/ranking_interactions")
    towers = spark.read.parquet(f"{etl}/two_tower_interactions")
    assert len(wide.columns) == 51 and len(towers.columns) == 48
    assert wide.count() == towers.count() == spark.read.parquet(f"{etl}/clean/transactions").count()

    vectors = f"{tmp_path}/vectors"
    main(["features", "--source", etl, "--output", features, "--embeddings", vectors, "--env", "test"])
    metadata = json.loads(spark.read.text(f"{features}/artifacts/split_metadata").first().value)
    assert metadata["train_rows"] + metadata["validation_rows"] + metadata["test_rows"] == wide.count()
    assert len(spark.read.parquet(f"{features}/user_features").columns) == 9
    assert len(spark.read.parquet(f"{features}/item_features").columns) == 13
    ranked = spark.read.parquet(f"{features}/ranking_features")
    assert len(ranked.columns) == 15 and ranked.count() == metadata["train_rows"]
    assert ranked.where("day_of_week not between 1 and 7 or price_affinity < 0").isEmpty()
    stats = spark.read.json(f"{features}/artifacts/item_features_statistics")
    coverage = stats.where("kind = 'coverage'").first().value
    assert 0 < float(coverage) <= 1

    main(["training", "--source", etl, "--features", features, "--output", sets, "--embeddings", vectors])
    rows = spark.read.parquet(f"{sets}/ranking")
    assert {r.label for r in rows.select("label").distinct().collect()} == {0, 1}
    users = spark.read.parquet(f"{sets}/lookups/user_index")
    assert users.agg(F.max("customer_idx")).first()[0] == users.count() - 1
    whole = spark.read.parquet(f"{sets}/two_tower")
    assert whole.where("customer_idx is null or article_idx is null").isEmpty()

    source = Catalog(etl, {"embeddings": vectors})
    two_tower_chunks_job(spark, source, Catalog(features), sets, f"{tmp_path}/progress", 1)
    chunked = spark.read.parquet(f"{sets}/two_tower_chunks").drop("chunk").select(whole.columns)
    assert chunked.exceptAll(whole).isEmpty() and chunked.count() == whole.count()
    ranking_chunks_job(spark, source, Catalog(features), sets, f"{tmp_path}/ranking-progress", files_per_chunk=1)
    chunked = spark.read.parquet(f"{sets}/ranking_chunks").drop("chunk").select(rows.columns)
    assert chunked.exceptAll(rows).isEmpty() and chunked.count() == rows.count()


def test_chunks_continue_where_they_stopped(spark, tmp_path):
    inbox, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    spark.range(10).repartition(2).write.parquet(inbox)
    schema = spark.read.parquet(inbox).schema

    def double(df):
        return df.select((F.col("id") * 2).alias("id"))

    process_chunks(spark, inbox, schema, double, out, progress, files_per_chunk=1)
    assert spark.read.parquet(out).select("chunk").distinct().count() == 2
    spark.range(10, 15).write.mode("append").parquet(inbox)
    process_chunks(spark, inbox, schema, double, out, progress, files_per_chunk=1)
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == [2 * i for i in range(15)]
