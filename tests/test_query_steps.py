"""What the queries do once an item or a file, and not once a row or for the whole log."""

import contextlib
import glob

from pyspark.sql import functions as F

from testbed import queries


def test_vector_texts_are_made_once_an_item(spark, small):
    for name in ("ranking_dataset", "two_tower_dataset", "retrieval_dataset"):
        plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
        # The vectors come from a table as text; no row of the result makes its own.
        assert "transform(cast(image_embedding" not in plan, name


def test_chunks_are_as_many_files_as_the_log_needs(spark, tmp_path):
    log = spark.range(1000).withColumn("x", F.col("id") * 2)
    assert queries.write_chunk_files(log, str(tmp_path / "few"), 4) == 1
    assert len(glob.glob(str(tmp_path / "few" / "part-*"))) == 4
    assert queries.write_chunk_files(log, str(tmp_path / "many"), 4, rows_per_file=100) == 3
    assert len(glob.glob(str(tmp_path / "many" / "part-*"))) == 12
    assert spark.read.parquet(str(tmp_path / "many")).count() == 1000


def test_rankers_are_fitted_on_files_of_bounded_rows(spark, small, monkeypatch):
    stored, write = {}, queries.materialize

    def kept(df, name, *options):
        stored[name] = write(df, name, *options)
        return stored[name]

    monkeypatch.setattr(queries, "materialize", kept)
    monkeypatch.setattr(queries, "TRAINING_FILE_ROWS", 1000, raising=False)
    queries.fit_ranker(spark, small)
    files = stored["ranker-rows"].groupBy(F.input_file_name()).count()
    assert files.agg(F.max("count")).first()[0] == 1000


def test_cold_items_store_the_two_columns_of_the_fit_and_the_log_only_once(spark, small, monkeypatch):
    stored, write = {}, queries.materialize

    class Fitting(Exception):
        pass

    def kept(df, name, *rest):
        stored[name] = df.columns
        return write(df, name, *rest)

    def stop(*_, **__):
        raise Fitting

    monkeypatch.setattr(queries, "materialize", kept)
    monkeypatch.setattr(queries.t, "materialize", kept)
    monkeypatch.setattr(queries.models, "fit_retrieval", stop)
    with contextlib.suppress(Fitting):
        queries.fit_cold_items(spark, small)
    assert sorted(stored["warm-log"]) == ["article_id", "customer_id"] and "transactions" not in stored
