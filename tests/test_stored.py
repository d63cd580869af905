from __future__ import annotations

from clicktally.operators.stored import changed_only, lookup_counts, split_by_key
from tests.conftest import rows

KEYS = ("date", "userid")
SCHEMA = "date STRING, userid BIGINT, clickCount BIGINT"
STORED = [("d1", 1, 5), ("d1", 2, 7), ("d2", 1, 1)]
NEW = [("d1", 1, 5), ("d1", 2, 8), ("d1", 3, 1), ("d2", 1, 1)]


def frames(spark):
    return spark.createDataFrame(NEW, SCHEMA), spark.createDataFrame(STORED, SCHEMA)


def test_changed_only(spark):
    assert rows(changed_only(*frames(spark), KEYS)) == [("d1", 2, 8), ("d1", 3, 1)]


def test_changed_only_with_null_counts(spark):
    new = spark.createDataFrame([("d1", 1, None), ("d1", 2, None), ("d1", 3, None)], SCHEMA)
    stored = spark.createDataFrame([("d1", 1, None), ("d1", 2, 7)], SCHEMA)
    assert rows(changed_only(new, stored, KEYS)) == [("d1", 2, None), ("d1", 3, None)]


def test_split_by_key(spark):
    actions = {r[:2]: r[3] for r in rows(split_by_key(*frames(spark), KEYS))}
    assert actions == {("d1", 1): "update", ("d1", 2): "update", ("d1", 3): "insert", ("d2", 1): "update"}


def test_lookup_counts(spark):
    new, stored = frames(spark)
    wanted = new.union(new).select("userid", "date")
    expected = [("d1", 1, 5), ("d1", 2, 7), ("d1", 3, 0), ("d2", 1, 1)]
    assert rows(lookup_counts(wanted, stored, KEYS)) == expected


def test_both_sides_are_shuffled_once(spark):
    """Grouped input meets the table on the grouping's own partitioning."""
    new, stored = frames(spark)
    new = new.groupBy(*KEYS).sum("clickCount").withColumnRenamed("sum(clickCount)", "clickCount")
    stored = stored.groupBy(*KEYS).sum("clickCount").withColumnRenamed("sum(clickCount)", "clickCount")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = changed_only(new, stored, KEYS)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2
