"""Run every registered query beside its SQL and compare the rows."""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _normal(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> int:
    """The number of rows, equal on both sides; raises if they differ."""
    got = _normal(entry.queries()[name](spark, sf_dir).toPandas())
    want = _normal(con.execute(entry.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns), (list(got.columns), list(want.columns))
    assert len(got) == len(want), (len(got), len(want))
    for column in got.columns:
        assert got[column].dtype.kind == want[column].dtype.kind, (column, got[column].dtype, want[column].dtype)
        assert got[column].tolist() == want[column].tolist(), column
    return len(got)


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.oracle_sql())
    shared = tempfile.TemporaryDirectory(prefix="oracle-")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", shared.name)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for query in names:
        start = time.time()
        try:
            print(f"{query:32} ok   {compare(session, con, query, sf):8} rows {time.time() - start:6.2f} s", flush=True)
        except Exception as err:  # report all of them
            print(f"{query:32} FAIL {str(err)[:1500]}", flush=True)
    session.stop()
    shared.cleanup()
