from pyspark.sql import functions as F

from trolley.functions import scratch
from trolley.sources import lookups, sinks
from trolley.streaming import chunks


def held(spark):
    """Shuffles whose files are known to the session."""
    return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()


def log(spark):
    return spark.range(1000).select((F.col("id") % 50).alias("k"), "id").repartition(3, "k")


def test_tables_between_steps_leave_no_shuffle_files(spark, tmp_path):
    before, setting = held(spark), spark.conf.get(scratch._CLEANUP)
    stored = scratch.materialize(log(spark), "log")
    sinks.write_table(stored, str(tmp_path / "in"), files=2)
    lookup = lookups.write_lookup(stored.select("k").distinct(), str(tmp_path / "lookup"), "k")
    held_by_chunks = []

    def chunk(df):
        held_by_chunks.append(held(spark))
        return lookups.look_up(df, lookup, "left_semi").groupBy("k").count()

    paths = [str(tmp_path / p) for p in ("in", "out", "progress")]
    chunks.process_chunks(spark, paths[0], stored.schema, chunk, *paths[1:], files_per_chunk=1)
    held_by_chunks.append(held(spark))
    # Those of earlier tests may go meanwhile.
    assert len(held_by_chunks) == 3 and max(held_by_chunks) <= before
    assert chunks.read_chunks(spark, paths[1]).agg(F.sum("count")).first()[0] == 1000
    assert spark.conf.get(scratch._CLEANUP) == setting
