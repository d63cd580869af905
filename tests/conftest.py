from __future__ import annotations

import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def zone(spark):
    """Work in another session time zone for the length of a test."""

    @contextmanager
    def use(name: str):
        spark.conf.set("spark.sql.session.timeZone", name)
        try:
            yield
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")

    return use


def rows(df) -> list[tuple]:
    """All rows as plain tuples, in order of their values."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
