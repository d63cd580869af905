from __future__ import annotations

import json

from clicktally.operators.enrich import Rule, apply_rules, parse_vehicles, to_json_value, vehicle_rejects
from clicktally.sources.sql import query
from tests.conftest import rows


def test_rules_go_in_order_and_skip_null_predicates(spark):
    df = spark.createDataFrame([(1, "a"), (5, "b"), (None, "c")], "n INT, s STRING")
    rules = [Rule("n > 3", "s", "'big'"), Rule("s = 'big'", "n", "n * 2L")]
    out = apply_rules(df, rules)
    assert rows(out) == [(1, "a"), (10, "big"), (None, "c")]
    assert out.schema == df.schema


def test_no_rules(spark):
    df = spark.createDataFrame([(1,)], "n INT")
    assert apply_rules(df, []) is df


GOOD = '{"gpstime":"2024-01-01 10:00:00","lon":1.5,"lat":2.0,"speaker":"s","mnetworkcode":"m"}'
MORE = '{"lat":2.0,"plate":"A","n":{"a":[1,2]},"s":"1","z":null}'
BAD = {"{": "malformed", "not json": "malformed", "[1]": "malformed", '{"lon":"x"}': "wrong_type", '{"gpstime":"soon"}': "wrong_type"}


def test_json_round_trip(spark):
    data = [("k", GOOD), ("more", MORE), ("none", "{}"), ("only", '{"plate":1}'), *((t, t) for t in BAD), ("null", None)]
    df = spark.createDataFrame(data, "key STRING, value STRING")
    back = to_json_value(parse_vehicles(df), "key")
    got = {r.key: json.loads(r.value) for r in back.collect()}
    want = {"k": json.loads(GOOD), "more": json.loads(MORE), "none": {}, "only": {"plate": 1}}
    assert got == want
    bad = {r.value: r.reason for r in vehicle_rejects(df).collect()}
    assert bad == {**BAD, None: "malformed"}


def test_fields_stay_as_they_came(spark):
    """Names without quotes, repeated names inside an object, the text of numbers, texts that look like numbers."""
    values = [
        '{lon:1.5,plate:"A"}',
        '{"lon":"2.5","x":1.10,"big":12345678901234567890123,"e":1e5,"neg":-0.0}',
        '{"n":{"a":1,"a":2.50},"t":true}',
        '{"a":"1.10","b":"true","c":"[1]","d":"{}","e":"null","f":"-5","g":"he said \\"x\\" \\\\ é\\u00e9","":1}',
        '{"arr":[1.0,"x",{"y":null}],"z":null,"speaker":12}',
    ]
    df = spark.createDataFrame(list(enumerate(values)), "key INT, value STRING")
    back = {r.key: r.value for r in to_json_value(parse_vehicles(df), "key").collect()}
    assert back[0] == '{"lon":1.5,"plate":"A"}'
    assert back[1] == '{"lon":2.5,"x":1.10,"big":12345678901234567890123,"e":1e5,"neg":-0.0}'
    assert back[2] == '{"n":{"a":1,"a":2.5},"t":true}'
    assert json.loads(back[3]) == json.loads(values[3])
    assert back[4] == '{"speaker":"12","arr":[1.0,"x",{"y":null}],"z":null}'
    assert vehicle_rejects(df).count() == 0
    text = parse_vehicles(df.filter("key < 3"))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json(StructField") == 0 and text.count("MapType") <= 2


def test_wrong_types(spark):
    bad = ['{"lat":"1.5d"}', '{"lon":true}', '{"gpstime":"2024-13-01 00:00:00"}', '{"lon":{"a":1}}']
    good = ['{"gpstime":1704103200}', '{"lon":1e3,"lat":-2}', '{"lon":null,"gpstime":null}']
    df = spark.createDataFrame([(v, v) for v in bad + good], "key STRING, value STRING")
    assert {r.value: r.reason for r in vehicle_rejects(df).collect()} == dict.fromkeys(bad, "wrong_type")
    assert parse_vehicles(df).count() == len(good)


def test_positional_parameters(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n BIGINT, s STRING")
    text = "SELECT n FROM {t} WHERE s <=> ? OR n > ?"
    assert rows(query(spark, text, ["a", 2], t=df)) == [(1,), (3,)]
    assert rows(query(spark, text, [None, 100], t=df)) == [(3,)]
    assert rows(query(spark, "SELECT count(*) FROM {t}", t=df)) == [(3,)]
