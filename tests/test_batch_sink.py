import os

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from trolley.sources.batch_sink import commits, read_batches, write_batches


def numbered(spark, ids, word="first"):
    return spark.range(ids).select(
        F.floor(F.col("id") / 10).alias("batch_no"),
        "id",
        F.array(F.col("id").cast("float"), F.lit(0.5).cast("float")).alias("vector"),
        F.struct(F.lit(word).alias("word"), (F.col("id") % 3).alias("n")).alias("metadata"),
    )


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_round_trip_with_nested_columns(spark, tmp_path):
    rows = numbered(spark, 1_005)
    write_batches(rows, str(tmp_path))
    found = read_batches(spark, str(tmp_path), rows.schema)
    assert found.dtypes == rows.dtypes and same(found, rows)
    (commit,) = commits(spark, str(tmp_path))
    assert commit["rows"] == 1_005 and len(commit["files"]) <= 8
    stored = spark.read.parquet(f"{tmp_path}/data")
    places = stored.select("batch_no", F.input_file_name().alias("file")).distinct()
    assert places.count() == 101  # a batch lies in one file


def test_a_batch_written_again_is_replaced_as_a_whole(spark, tmp_path):
    rows = numbered(spark, 100)
    write_batches(rows, str(tmp_path))
    write_batches(rows, str(tmp_path))
    assert same(read_batches(spark, str(tmp_path), rows.schema), rows)
    shorter = numbered(spark, 100, "second").where("batch_no >= 8 and id % 2 = 0")
    write_batches(shorter, str(tmp_path))
    expected = rows.where("batch_no < 8").unionByName(shorter)
    assert same(read_batches(spark, str(tmp_path), rows.schema), expected)
    write_batches(shorter, str(tmp_path), overwrite=True)
    assert same(read_batches(spark, str(tmp_path), rows.schema), shorter)


def test_a_failed_run_leaves_nothing_visible(spark, tmp_path):
    rows = numbered(spark, 100)
    write_batches(rows, str(tmp_path))
    files = sorted(os.listdir(tmp_path / "data"))
    breaks = F.when(F.col("id") == 99, F.raise_error(F.lit("broken row"))).otherwise(F.col("id"))
    with pytest.raises(PySparkException):
        write_batches(numbered(spark, 100, "second").withColumn("id", breaks.cast("bigint")), str(tmp_path))
    assert len(commits(spark, str(tmp_path))) == 1
    assert sorted(f for f in os.listdir(tmp_path / "data")) == files
    assert same(read_batches(spark, str(tmp_path), rows.schema), rows)


def test_null_numbers_empty_tables_and_columns_that_clash(spark, tmp_path):
    rows = numbered(spark, 15).withColumn("batch_no", F.nullif("batch_no", F.lit(1).cast("bigint")))
    write_batches(rows, f"{tmp_path}/nulls")
    write_batches(rows, f"{tmp_path}/nulls")
    assert same(read_batches(spark, f"{tmp_path}/nulls", rows.schema), rows)
    assert read_batches(spark, f"{tmp_path}/none", rows.schema).isEmpty()
    write_batches(rows.limit(0), f"{tmp_path}/empty")
    assert read_batches(spark, f"{tmp_path}/empty", rows.schema).isEmpty()
    for broken in (rows.drop("batch_no"), rows.withColumn("_run", F.lit(""))):
        with pytest.raises(Exception):
            write_batches(broken, f"{tmp_path}/clash")
