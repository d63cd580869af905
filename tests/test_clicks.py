from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clicktally.functions.columns import click_key, click_key_part, date_time_text, epoch_timestamp
from clicktally.operators import clicks
from clicktally.schemas import CLICK_RECORD
from tests.conftest import rows

# A record with every field of the feed.
SAMPLE = {
    "user_id": 42,
    "user_ipaddress": "192.0.2.1",
    "timestamp": 1568190112,
    "referer": "",
    "url": "https://example.org/product?id=7",
    "location": "app",
    "device": "ANDROID",
    "content": {
        "user_id": 42,
        "click_position": "app_restart",
        "deviceID": "device-1",
        "gid": "group-1",
        "ver": "1.0",
    },
}


def record(position="app_restart", **fields) -> str:
    base = {"user_id": 1, "timestamp": 1568190112, "content": {"click_position": position}}
    return json.dumps({**base, **fields})


def parsed(spark, *values):
    data = [(str(i), v) for i, v in enumerate(values)]
    return clicks.parse_clicks(spark.createDataFrame(data, "key STRING, value STRING"))


def counted(spark, *values, position="app_restart"):
    return rows(clicks.running_clicks(clicks.countable(parsed(spark, *values), position)))


def reasons(spark, *values):
    return [r.reason for r in clicks.rejects(parsed(spark, *values)).orderBy("key").collect()]


def test_full_record_is_counted(spark):
    text = json.dumps(SAMPLE)
    assert counted(spark, text, text) == [("2019-09-11", "app_restart", "42", 2)]


def test_whole_record_schema(spark):
    df = spark.createDataFrame([(json.dumps(SAMPLE),)], "value STRING")
    row = clicks.read_json(df, CLICK_RECORD).first()
    assert row.content.deviceID == "device-1"
    assert (row.user_id, row.timestamp, row.device) == ("42", "1568190112", "ANDROID")


@pytest.mark.parametrize("user", ["", None, "missing"])
def test_no_user_becomes_anonymous(spark, user):
    fields = json.loads(record())
    if user == "missing":
        del fields["user_id"]
    else:
        fields["user_id"] = user
    assert counted(spark, json.dumps(fields)) == [("2019-09-11", "app_restart", "-99", 1)]


def test_blank_user_stays(spark):
    assert counted(spark, record(user_id=" ")) == [("2019-09-11", "app_restart", " ", 1)]


def test_quoted_timestamp_is_counted(spark):
    assert counted(spark, record(timestamp="1568190112")) == [("2019-09-11", "app_restart", "1", 1)]


def test_unquoted_names_are_read(spark):
    text = '{user_id: 1, timestamp: 1568190112, content: {click_position: "app_restart"}}'
    assert counted(spark, text) == [("2019-09-11", "app_restart", "1", 1)]


def test_position_is_exact(spark):
    values = [record("APP_RESTART"), record("app_restart "), record("app_restart2"), record(None)]
    assert counted(spark, *values) == []
    assert reasons(spark, *values) == []


def test_content_without_position_is_an_ordinary_drop(spark):
    text = json.dumps({"user_id": 1, "timestamp": 1568190112, "content": {}})
    assert counted(spark, text, position=None) == []
    assert reasons(spark, text) == []


def test_rejects(spark):
    whole = record()
    values = [
        whole[:-1],  # cut off
        "[1, 2]",
        "nothing",
        record(content="text"),
        record(content=[1]),
        record(content=None),
        json.dumps({"user_id": 1, "timestamp": 1}),
        "",
        None,
        record(timestamp=None),
        record(timestamp="soon"),
        record(timestamp=1568190112.5),
        record(timestamp=10**30),
    ]
    assert reasons(spark, *values[:5]) == ["malformed"] * 5
    assert reasons(spark, *values[5:9]) == ["no_content"] * 4
    assert reasons(spark, *values[9:]) == ["bad_timestamp"] * 4
    assert counted(spark, *values) == []


def test_bad_timestamp_at_another_position_is_an_ordinary_drop(spark):
    text = record("home", timestamp="soon")
    assert reasons(spark, text) == []
    assert counted(spark, text) == []


def test_every_record_is_counted_dropped_or_rejected_once(spark):
    values = [record(), record("home"), record(timestamp="x"), "{", record(user_id="")]
    both = parsed(spark, *values)
    kept = clicks.countable(both).count()
    bad = clicks.rejects(both).count()
    assert (kept, bad, len(values) - kept - bad) == (2, 2, 1)


def test_separator_in_parts_is_kept(spark):
    assert counted(spark, record("a|b", user_id="c|d"), position="a|b") == [
        ("2019-09-11", "a|b", "c|d", 1)
    ]


@pytest.mark.parametrize(
    "name, date", [("UTC", "2019-09-11"), ("Asia/Shanghai", "2019-09-12"), ("America/New_York", "2019-09-11")]
)
def test_date_follows_the_session_zone(spark, zone, name, date):
    near_midnight = 1568190112 + 8 * 3600  # 16:21:52 UTC
    with zone(name):
        assert counted(spark, record(timestamp=near_midnight)) == [(date, "app_restart", "1", 1)]


def test_date_time_text(spark):
    df = spark.createDataFrame([("1568190191",)], "s STRING")
    assert df.select(date_time_text(epoch_timestamp(F.col("s")))).first()[0] == "2019-09-11 08:23:11"


def test_hourly_pv(spark):
    values = [record(timestamp=t) for t in (0, 3599, 3600)]
    good = clicks.countable(parsed(spark, *values))
    assert rows(clicks.hourly_pv(good)) == [("1970-01-01 00", 2), ("1970-01-01 01", 1)]


def test_hourly_counts(spark):
    values = [record(timestamp=t) for t in (0, 3599, 3600, 221845392000)]
    good = clicks.countable(parsed(spark, *values))
    want = [("1970-01-01", "1970-01-01 00", 2), ("1970-01-01", "1970-01-01 01", 1), ("9000-01-01", "9000-01-01 00", 1)]
    assert rows(clicks.hourly_counts(good)) == want


def test_far_times_are_counted_and_only_overflow_is_a_reject(spark):
    last = 9223372036854
    good = clicks.countable(parsed(spark, record(timestamp=1568190112000), record(timestamp=last)))
    assert [r.date for r in good.select("date").orderBy("date").collect()] == ["294247-01-10", "51663-12-19"]
    bad = [record(timestamp=last + 1), record(timestamp=10**19), record(timestamp="1.5")]
    assert reasons(spark, *bad) == ["bad_timestamp"] * 3


def test_page_pv_uv(spark):
    values = [record(user_id=u) for u in (1, 1, 2, "", None)]
    counts = clicks.running_clicks(clicks.countable(parsed(spark, *values)))
    assert rows(clicks.page_pv_uv(counts)) == [("2019-09-11", "app_restart", 5, 3)]


def test_click_key_round_trip(spark):
    df = spark.createDataFrame([("aa", "bb", "cc")], "d STRING, p STRING, u STRING")
    key = click_key(F.col("d"), F.col("p"), F.col("u"))
    parts = df.select(key.alias("k")).select("k", *(click_key_part(F.col("k"), i) for i in range(4)))
    assert tuple(parts.first()) == ("aa|bb|cc", "aa", "bb", "cc", None)


def test_text_is_parsed_once(spark):
    feed = spark.createDataFrame([("k", record())], "key STRING, value STRING")
    counts = clicks.running_clicks(clicks.countable(clicks.parse_clicks(feed)))
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
