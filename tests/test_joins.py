"""Filtered joins: exact whatever the filter lets through, and few rows moved."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from clicktally.operators import ads, joins
from tests.conftest import rows


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_filter_excludes_most_and_loses_none(spark):
    left = spark.range(20_000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("t"))
    listed = spark.range(0, 20_000, 10).select(F.col("id").cast("int").alias("k"))  # of another type
    tested = joins.may_be_in(left, listed, ["k"], "maybe")
    assert tested.columns == ["k", "t", "maybe"] and tested.count() == 20_000
    assert tested.filter("maybe AND k % 10 = 0").count() == 2000
    assert tested.filter("maybe").count() < 2000 + 0.02 * 18_000
    assert joins.may_be_in(left, listed.limit(0), ["k"], "maybe").filter("maybe").count() == 0


def test_a_filter_that_is_too_small_stays_exact(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_BLOCKS", 1)
    left = spark.range(5000).withColumnRenamed("id", "k")
    listed = spark.range(0, 5000, 3).withColumnRenamed("id", "k")
    assert joins.may_be_in(left, listed, ["k"], "maybe").filter("maybe").count() > 2500
    assert joins.filtered_join(left, listed, ["k"], "left_anti").filter("k % 3 = 0").count() == 0
    assert joins.filtered_join(left, listed, ["k"], "left_semi").count() == listed.count()


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_filtered_join_equals_the_join(spark, how):
    left = spark.createDataFrame([(i % 50 if i % 7 else None, f"r{i}") for i in range(300)] + [(3, "same")] * 3, "a bigint, b string")
    right = spark.createDataFrame([(i,) for i in range(0, 50, 4)] + [(None,), (4,)], "a bigint")
    found = joins.filtered_join(left, right, ["a"], how)
    assert found.columns == left.columns
    assert rows(found) == rows(left.join(right, "a", how))
    assert rows(joins.filtered_join(left.limit(0), right, ["a"], how)) == []
    with pytest.raises(ValueError, match="left_semi or left_anti"):
        joins.filtered_join(left, right, ["a"], "inner")


def test_few_clicks_move(spark, no_broadcast, tmp_path):
    """Two branches; only what may be listed, some more than a tenth, goes through an exchange."""
    clicks = spark.range(30_000).selectExpr("id AS event_id", "id % 3000 AS userid")
    clicks.write.parquet(str(tmp_path / "clicks"))
    clicks = spark.read.parquet(str(tmp_path / "clicks"))
    listed = spark.range(0, 3000, 10).selectExpr("cast(id AS string) AS userid")
    left = ads.drop_blacklisted(clicks, listed, prefilter=True)
    assert rows(left) == rows(clicks.filter("userid % 10 <> 0"))
    text = plan(left)
    assert text.count("Union") >= 1 and "BroadcastHashJoin" in text and "SortMergeJoin" in text
    moved = joins.may_be_in(clicks, listed.selectExpr("cast(userid AS bigint) AS userid"), ["userid"], "m").filter("m").count()
    assert 3000 <= moved < 3600
