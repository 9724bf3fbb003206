"""Run queries in Spark and DuckDB and compare rows, column names and values."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession


def session(cores: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


# DuckDB type names and the Spark types they must meet.
TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "FLOAT": "float",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
}


def _plain(value):
    if value is None or value != value:
        return None
    if hasattr(value, "to_pydatetime"):
        return value.to_pydatetime()
    if hasattr(value, "item"):
        return value.item()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df: DataFrame, connection, statement: str) -> str | None:
    """None when equal, else what differs first."""
    expected = connection.execute(statement)
    names = [d[0] for d in expected.description]
    wanted = rows_of(names, expected.fetchall())
    found = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    kinds = dict(df.dtypes)
    described = connection.execute(f"DESCRIBE {statement}").fetchall()
    unlike = [(n, kinds[n], k) for n, k, *_ in described if TYPES.get(k, k) != kinds[n]]
    if unlike:
        return f"types {unlike}"
    if len(found) != len(wanted):
        return f"rows {len(found)} / {len(wanted)}"
    bad = [(a, b) for a, b in zip(found, wanted) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    from testbed.oracles import oracle_statements
    from testbed.queries import QUERIES

    folder = sys.argv[1]
    chosen = sys.argv[2:] or list(QUERIES)
    spark, connection, statements = session(), duck(folder), oracle_statements()
    failed = 0
    for name in chosen:
        start = time.time()
        try:
            df = QUERIES[name](spark, folder)
            if name in statements:
                found = differences(df, connection, statements[name])
            else:
                found = None if df.collect() else "no rows"
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        verdict = "ok" if found is None else f"DIFFERENT {found[:900]}"
        print(f"{name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main())
