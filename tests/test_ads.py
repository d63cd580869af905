from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from clicktally.operators import ads
from clicktally.operators.joins import hot_key_join
from tests.conftest import rows

CLICK = "date STRING, hour STRING, minute STRING, userid BIGINT, province STRING, city STRING, adid BIGINT"


def ad_clicks(spark):
    data = [
        ("d1", "00", "01", 1, "p", "c1", 1),
        ("d1", "00", "01", 1, "p", "c1", 1),
        ("d1", "00", "02", 2, "p", "c2", 1),
        ("d1", "00", "02", 2, "p", "c2", 2),
        ("d1", "01", "00", 1, "p", "c1", 3),
        ("d1", "01", "00", 3, "p", "c1", 4),
        ("d2", "00", "00", 3, "q", "c3", 4),
    ]
    return spark.createDataFrame(data, CLICK)


def test_counts_by_grain(spark):
    clicks = ad_clicks(spark)
    assert ("d1", 1, 1, 2) in rows(ads.user_ad_counts(clicks))
    assert ("d1", "p", "c1", 1, 2) in rows(ads.region_ad_counts(clicks))
    assert ("d1", "00", "02", 2, 1) in rows(ads.minute_ad_counts(clicks))


def test_counts_of_counts(spark):
    per_city = ads.region_ad_counts(ad_clicks(spark))
    assert rows(ads.region_ad_sums(per_city)) == rows(per_city)
    assert {r.clickCount for r in ads.region_ad_counts(per_city).collect()} == {1}  # rows, whatever they are called


def test_top_ads_with_ties_and_small_groups(spark):
    top = ads.province_top_ads(ads.region_ad_counts(ad_clicks(spark)))
    assert rows(top) == [("d1", "p", 1, 3), ("d1", "p", 2, 1), ("d1", "p", 3, 1), ("d2", "q", 4, 1)]


def test_top_ads_are_cut_before_the_shuffle(spark):
    plan = ads.province_top_ads(ads.region_ad_counts(ad_clicks(spark)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 3, Partial" in text


def test_region_join_and_users_over(spark):
    counts = ads.user_ad_counts(ad_clicks(spark))
    regions = spark.createDataFrame([(1, "p", "c1"), (2, "p", "c2")], "userid BIGINT, province STRING, city STRING")
    assert {r.userid for r in ads.with_region(counts, regions).collect()} == {1, 2}
    assert rows(ads.users_over(counts, 1)) == [(1,)]
    assert rows(ads.users_over(counts, 2)) == []


def test_drop_blacklisted_with_repeated_ids(spark):
    listed = spark.createDataFrame([(1,), (1,), (9,)], "userid BIGINT")
    left = ads.drop_blacklisted(ad_clicks(spark), listed)
    assert Counter(r.userid for r in left.collect()) == {2: 2, 3: 2}


def test_a_blacklist_is_salted(spark):
    listed = spark.createDataFrame([(1,), (1,), (9,)], "userid BIGINT")
    left = ads.drop_blacklisted(ad_clicks(spark), listed)
    assert "_salt" in left._jdf.queryExecution().executedPlan().toString()
    assert Counter(r.userid for r in left.collect()) == {2: 2, 3: 2}


def test_drop_blacklisted_with_text_users(spark):
    clicks = spark.createDataFrame([("1",), ("-99",), (" ",), ("x",), (None,)], "userid STRING")
    listed = spark.createDataFrame([(1,), (-99,)], "userid BIGINT")
    assert rows(ads.drop_blacklisted(clicks, listed)) == [(" ",), ("x",), (None,)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_hot_key_join_equals_a_plain_join(spark, how):
    """A third of the left rows have one key; the right side repeats some keys."""
    left = spark.range(0, 900, 1, 6).selectExpr("IF(id % 3 = 0, 7, id % 40) AS userid", "id")
    right = spark.range(30).selectExpr("id AS userid", "'a' AS tag").union(
        spark.range(5, 9).selectExpr("id AS userid", "'b' AS tag")
    )
    got = hot_key_join(left, right, ["userid"], how, salts=4)
    expected = left.join(right, "userid", how)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


def test_salts_spread_a_hot_key(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.range(0, 900, 1, 6).selectExpr("IF(id < 600, 7, id) AS userid", "id")
        right = spark.createDataFrame([(1,)], "userid BIGINT")
        got = hot_key_join(left, right, ["userid"], "left_anti", salts=4)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("hashpartitioning(userid") == 2
        assert all("_salt" in part[:60] for part in plan.split("hashpartitioning(userid")[1:])
        assert got.count() == 900
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_a_hot_user_in_one_partition_reaches_several_salts(spark):
    left = spark.range(1000).selectExpr("7L AS userid", "id").repartition("userid")
    right = spark.createDataFrame([(7,)], "userid BIGINT")
    got = hot_key_join(left, right, ["userid"], "inner", salts=16)
    assert got.count() == 1000
    salt = F.pmod(F.xxhash64("id"), F.lit(16))
    assert left.select(salt).distinct().count() == 16


def test_streams_are_refused_by_the_blacklist(spark):
    stream = spark.readStream.format("rate").load().selectExpr("value AS userid")
    with pytest.raises(ValueError, match="anew"):
        ads.drop_blacklisted(stream, spark.createDataFrame([(1,)], "userid BIGINT"))


def test_users_without_a_region_are_rejects(spark):
    counts = spark.createDataFrame([(1, 5), (2, 6)], "userid BIGINT, clickCount BIGINT")
    regions = spark.createDataFrame([(1, "p", "c")], "userid BIGINT, province STRING, city STRING")
    assert rows(ads.with_region(counts, regions)) == [(1, 5, "p", "c")]
    assert rows(ads.without_region(counts, regions)) == [(2, 6)]
