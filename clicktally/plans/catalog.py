"""The registered queries, each next to the SQL that gives the same result.

Queries on kept tables write two batches: the counts of the mornings, then those of the afternoons
(or of the whole days), so that keys are updated, inserted and left alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.config import new_run_dir
from clicktally.functions.columns import click_key, click_key_part, date_text
from clicktally.operators import ads, clicks, enrich, stored
from clicktally.plans import fixtures
from clicktally.schemas import (
    AD_BLACKLIST,
    AD_CLICK_TREND,
    AD_CLICK_TREND_SUM,
    AD_PROVINCE_TOP3,
    AD_STAT,
    AD_STAT_SUM,
    AD_USER_CLICK_COUNT,
    HOURLY_PV,
    INDEX_CLICK_COUNT,
    INDEX_CLICK_COUNT_ROWS,
    INDEX_CLICK_COUNT_SUM,
    PAGE_VISITORS,
    VEHICLE_RECORD,
    TableSpec,
)
from clicktally.sources import feed as feeds
from clicktally.sources import rules, sql, tables
from clicktally.sources.tables import ResultTable
from clicktally.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def registered(oracle: str) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLE[query.__name__] = oracle
        return query

    return add


def _new_table(spark: SparkSession, spec: TableSpec) -> ResultTable:
    return ResultTable(spec, new_run_dir(spark, spec.name))


def _parsed(
    spark: SparkSession,
    sf_dir: str,
    position: str | None = None,
    part: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    feed = fixtures.click_feed(part(fixtures.events(spark, sf_dir))).drop("ts")
    return clicks.countable(clicks.parse_clicks(feed), position)


def _ad_clicks(spark: SparkSession, sf_dir: str, position: str | None = "click") -> DataFrame:
    return clicks.filter_position(fixtures.ad_clicks(fixtures.events(spark, sf_dir)), position)


def _region_counts(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Counts per user come first, so a busy user is one row per day and ad before the join."""
    per_user = ads.user_ad_counts(rows)
    return ads.region_ad_sums(ads.with_region(per_user, fixtures.user_regions(spark, sf_dir)))


# SQL views shared by the oracles. ``props`` holds k; see the fixtures.
_EVENTS = """
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract(props, '$.k') AS INTEGER) AS k
    FROM events"""
_CLICKS = f"""
    SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS date, event_type AS position,
           CASE WHEN k < 5 THEN '-99' ELSE CAST(user_id AS VARCHAR) END AS userid
    FROM ({_EVENTS})"""
_AD_EVENTS = f"""
    SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
           strftime(ts, '%M') AS minute, event_type, user_id AS userid,
           CAST(floor(k / 10.0) AS BIGINT) AS adid
    FROM ({_EVENTS})"""
_AD_CLICKS = f"SELECT * FROM ({_AD_EVENTS}) WHERE event_type = 'click'"
_MORNING = "hour(ts) < 12"
_AFTERNOON = "hour(ts) >= 12"


def _index_sql(where: str = "TRUE") -> str:
    return f"""
    SELECT date, position, userid, count(*) AS clickCount
    FROM ({_CLICKS}) WHERE {where} GROUP BY date, position, userid"""


def _user_ad_sql(where: str = "TRUE") -> str:
    return f"""
    SELECT date, userid, adid, count(*) AS clickCount
    FROM ({_AD_CLICKS}) WHERE {where} GROUP BY date, userid, adid"""


def _region_sql(source: str, where: str = "TRUE") -> str:
    return f"""
    SELECT date, r_name AS province, n_name AS city, adid, count(*) AS clickCount
    FROM ({source}) AS a
    JOIN customer ON userid = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    WHERE {where} GROUP BY date, r_name, n_name, adid"""


def _trend_sql(where: str = "TRUE") -> str:
    return f"""
    SELECT date, hour, minute, adid, count(*) AS clickCount
    FROM ({_AD_EVENTS}) WHERE {where} GROUP BY date, hour, minute, adid"""


def _top3_sql(source: str, where: str = "TRUE") -> str:
    return f"""
    SELECT date, province, adid, clickCount FROM (
        SELECT date, province, adid, CAST(sum(clickCount) AS BIGINT) AS clickCount,
               row_number() OVER (PARTITION BY date, province
                                  ORDER BY sum(clickCount) DESC, adid) AS place
        FROM ({_region_sql(source, where)}) GROUP BY date, province, adid)
    WHERE place <= 3"""


def _overwrite_sql(base: str, new: str, keys: Sequence[str]) -> str:
    names = ", ".join(keys)
    return f"""
    SELECT {names}, coalesce(n.clickCount, b.clickCount) AS clickCount
    FROM ({base}) AS b FULL OUTER JOIN ({new}) AS n USING ({names})"""


_INDEX_CLICKS = _index_sql("position = 'click'")


@registered(_INDEX_CLICKS)
def click_count_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.running_clicks(_parsed(spark, sf_dir, "click"))


@registered(_index_sql())
def click_count_all_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.running_clicks(_parsed(spark, sf_dir))


@registered(f"""
    SELECT date || '|' || position || '|' || userid AS click_key, date AS date_part,
           position AS position_part, userid AS userid_part, clickCount
    FROM ({_index_sql()})""")
def click_key_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = clicks.running_clicks(_parsed(spark, sf_dir))
    keyed = counts.select(
        click_key(F.col("date"), F.col("position"), F.col("userid")).alias("click_key"), "clickCount"
    )
    return keyed.select(
        "click_key",
        click_key_part(F.col("click_key"), 0).alias("date_part"),
        click_key_part(F.col("click_key"), 1).alias("position_part"),
        click_key_part(F.col("click_key"), 2).alias("userid_part"),
        "clickCount",
    )


_REJECTS = f"""
    SELECT event_id, CASE WHEN k < 20 THEN 'malformed' WHEN k < 40 THEN 'no_content'
                          WHEN k < 60 THEN 'malformed' ELSE 'bad_timestamp' END AS reason
    FROM ({_EVENTS}) WHERE event_type = 'error' AND k < 80"""


@registered(_REJECTS)
def parse_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixtures.damaged_feed(fixtures.events(spark, sf_dir))
    return clicks.rejects(clicks.parse_clicks(feed), "error").select("event_id", "reason")


@registered(f"SELECT strftime(ts, '%Y-%m-%d %H') AS datehour, count(*) AS pv FROM ({_CLICKS}) GROUP BY 1")
def hourly_pv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.hourly_pv(_parsed(spark, sf_dir))


@registered(f"""
    SELECT date, position, count(*) AS pv, count(DISTINCT userid) AS uv
    FROM ({_CLICKS}) GROUP BY date, position""")
def page_pv_uv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.page_pv_uv(clicks.running_clicks(_parsed(spark, sf_dir)))


@registered(_user_ad_sql())
def user_ad_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.user_ad_counts(_ad_clicks(spark, sf_dir))


@registered(_region_sql(_AD_CLICKS))
def region_ad_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _region_counts(spark, sf_dir, _ad_clicks(spark, sf_dir))


@registered(_trend_sql("event_type = 'click'"))
def minute_ad_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.minute_ad_counts(_ad_clicks(spark, sf_dir))


@registered(_top3_sql(_AD_CLICKS))
def province_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ads.province_top_ads(_region_counts(spark, sf_dir, _ad_clicks(spark, sf_dir)))


# --- against a kept table -------------------------------------------------------------------------


def _morning_index(spark: SparkSession, sf_dir: str) -> ResultTable:
    table = _new_table(spark, INDEX_CLICK_COUNT)
    counts = clicks.running_clicks(_parsed(spark, sf_dir, part=fixtures.morning))
    tables.upsert_overwrite(counts, table, batch=0, unique=True)
    return table


def _afternoon_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clicks.running_clicks(_parsed(spark, sf_dir, part=fixtures.afternoon))


@registered(f"""
    SELECT n.* FROM ({_index_sql()}) AS n
    WHERE NOT EXISTS (
        SELECT 1 FROM ({_index_sql(_MORNING)}) AS b
        WHERE b.date = n.date AND b.position = n.position AND b.userid = n.userid
          AND b.clickCount = n.clickCount)""")
def changed_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _morning_index(spark, sf_dir)
    counts = clicks.running_clicks(_parsed(spark, sf_dir))
    return stored.changed_only(counts, tables.read_table(spark, table), table.spec.keys)


@registered(f"""
    SELECT n.*, CASE WHEN b.clickCount IS NULL THEN 'insert' ELSE 'update' END AS action
    FROM ({_index_sql(_AFTERNOON)}) AS n LEFT JOIN ({_index_sql(_MORNING)}) AS b
    ON b.date = n.date AND b.position = n.position AND b.userid = n.userid""")
def split_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _morning_index(spark, sf_dir)
    new = _afternoon_index(spark, sf_dir)
    return stored.split_by_key(new, tables.read_table(spark, table), table.spec.keys)


@registered(_overwrite_sql(_index_sql(_MORNING), _index_sql(_AFTERNOON), INDEX_CLICK_COUNT.keys))
def upsert_overwrite_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _morning_index(spark, sf_dir)
    tables.upsert_overwrite(_afternoon_index(spark, sf_dir), table, batch=1)
    return tables.read_table(spark, table)


@registered(
    _overwrite_sql(
        _region_sql(_AD_CLICKS, _MORNING), _region_sql(_AD_CLICKS, _AFTERNOON), AD_STAT.keys
    )
)
def upsert_overwrite_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _new_table(spark, AD_STAT)
    rows = _ad_clicks(spark, sf_dir)
    for batch, part in enumerate((fixtures.morning(rows), fixtures.afternoon(rows))):
        tables.upsert_overwrite(_region_counts(spark, sf_dir, part), table, batch)
    return tables.read_table(spark, table)


@registered(
    _overwrite_sql(
        _trend_sql("second(ts) < 30"), _trend_sql("second(ts) >= 30"), AD_CLICK_TREND.keys
    )
)
def upsert_overwrite_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All positions, in two batches a minute: keys hold the minute."""
    table = _new_table(spark, AD_CLICK_TREND)
    rows = _ad_clicks(spark, sf_dir, position=None)
    for batch, half in enumerate((F.second("ts") < 30, F.second("ts") >= 30)):
        tables.upsert_overwrite(ads.minute_ad_counts(rows.filter(half)), table, batch)
    return tables.read_table(spark, table)


@registered(f"{_index_sql(_MORNING)} UNION ALL {_index_sql(_AFTERNOON)}")
def append_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _new_table(spark, INDEX_CLICK_COUNT_ROWS)
    for batch, part in enumerate((fixtures.morning, fixtures.afternoon)):
        tables.append(clicks.running_clicks(_parsed(spark, sf_dir, part=part)), table, batch)
    return tables.read_table(spark, table)


def _blacklist_sql(where: str) -> str:
    return f"SELECT DISTINCT userid FROM ({_user_ad_sql(where)}) WHERE clickCount > 1"


def _blacklist(spark: SparkSession, sf_dir: str) -> ResultTable:
    """Users with more than one click on an ad in a morning, then in an afternoon."""
    table = _new_table(spark, AD_BLACKLIST)
    rows = _ad_clicks(spark, sf_dir)
    for batch, part in enumerate((fixtures.morning(rows), fixtures.afternoon(rows))):
        tables.append(ads.users_over(ads.user_ad_counts(part), threshold=1), table, batch)
    return table


@registered(f"{_blacklist_sql(_MORNING)} UNION ALL {_blacklist_sql(_AFTERNOON)}")
def blacklist_append_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, _blacklist(spark, sf_dir))


@registered(f"""
    SELECT event_id, date, userid, adid FROM ({_AD_CLICKS})
    WHERE userid NOT IN ({_blacklist_sql(_MORNING)})
      AND userid NOT IN ({_blacklist_sql(_AFTERNOON)})""")
def drop_blacklisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    blacklist = tables.read_table(spark, _blacklist(spark, sf_dir))
    rows = _ad_clicks(spark, sf_dir).select("event_id", "date", "userid", "adid")
    return ads.drop_blacklisted(rows, blacklist)


@registered(ORACLE["drop_blacklisted"])
def drop_blacklisted_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is not broadcast, and all clicks of a user lie in one partition."""
    session = _stream_session(spark)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    blacklist = tables.read_table(session, _blacklist(session, sf_dir))
    rows = _ad_clicks(session, sf_dir).select("event_id", "date", "userid", "adid")
    return ads.drop_blacklisted(rows.repartition("userid"), blacklist)


_EVERY_TENTH = "SELECT c_custkey AS userid FROM customer WHERE c_custkey % 10 = 3"


@registered(f"""
    SELECT event_id, date, userid, adid FROM ({_AD_CLICKS}) WHERE userid NOT IN ({_EVERY_TENTH})""")
def drop_blacklisted_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth customer is listed; the clicks that a filter of the list excludes are not moved."""
    session = _stream_session(spark)
    session.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    session.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    blacklist = fixtures.table(session, sf_dir, "customer").selectExpr("c_custkey AS userid").filter("userid % 10 = 3")
    rows = _ad_clicks(session, sf_dir).select("event_id", "date", "userid", "adid")
    return ads.drop_blacklisted(rows, blacklist, prefilter=True)


def _user_ad_table(spark: SparkSession, *batches: DataFrame) -> ResultTable:
    table = _new_table(spark, AD_USER_CLICK_COUNT)
    for batch, rows in enumerate(batches):
        tables.upsert_accumulate(ads.user_ad_counts(rows), table, batch)
    return table


@registered(_user_ad_sql())
def upsert_accumulate_user_ad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches that add up to the whole, the second one delivered twice."""
    rows = _ad_clicks(spark, sf_dir)
    table = _user_ad_table(spark, fixtures.morning(rows), fixtures.afternoon(rows))
    tables.upsert_accumulate(ads.user_ad_counts(fixtures.afternoon(rows)), table, batch=1)
    return tables.read_table(spark, table)


@registered(f"""
    SELECT w.date, w.userid, w.adid, coalesce(b.clickCount, 0) AS clickCount
    FROM (SELECT DISTINCT date, userid, adid FROM ({_AD_CLICKS})) AS w
    LEFT JOIN ({_user_ad_sql(_MORNING)}) AS b
    ON b.date = w.date AND b.userid = w.userid AND b.adid = w.adid""")
def lookup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ad_clicks(spark, sf_dir)
    table = _user_ad_table(spark, fixtures.morning(rows))
    return stored.lookup_counts(rows, tables.read_table(spark, table), table.spec.keys)


@registered(f"""
    WITH base AS ({_top3_sql(_AD_CLICKS)}),
         half AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS middle FROM events),
         new AS ({_top3_sql(_AD_EVENTS, "date > (SELECT strftime(middle, '%Y-%m-%d') FROM half)")})
    SELECT * FROM new UNION ALL
    SELECT b.* FROM base AS b WHERE NOT EXISTS (
        SELECT 1 FROM new WHERE new.date = b.date AND new.province = b.province)""")
def province_top3_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top ads by click for all days, then those by any event for the days of the second half."""
    table = _new_table(spark, AD_PROVINCE_TOP3)
    base = ads.province_top_ads(_region_counts(spark, sf_dir, _ad_clicks(spark, sf_dir)))
    tables.replace_groups(base, table, batch=0)
    every = _ad_clicks(spark, sf_dir, position=None)
    first, last = every.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    middle = date_text(F.timestamp_micros(F.lit(first + (last - first) // 2)))
    recent = every.filter(F.col("date") > middle)
    tables.replace_groups(ads.province_top_ads(_region_counts(spark, sf_dir, recent)), table, batch=1)
    return tables.read_table(spark, table)


@registered(_overwrite_sql(_index_sql(_MORNING), _index_sql(_AFTERNOON), INDEX_CLICK_COUNT.keys))
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _morning_index(spark, sf_dir)
    tables.upsert_overwrite(_afternoon_index(spark, sf_dir), table, batch=1)
    return tables.read_table(spark, tables.compact(spark, table, new_run_dir(spark, "compacted")))


_HALF = "SELECT strftime(min(ts) + (max(ts) - min(ts)) / 2, '%Y-%m-%d') FROM events"


def _middle(rows: DataFrame) -> str:
    """The date in the middle of the rows' time."""
    first, last = rows.agg(F.min(F.unix_micros("ts")), F.max(F.unix_micros("ts"))).first()
    return rows.sparkSession.range(1).select(date_text(F.timestamp_micros(F.lit(first + (last - first) // 2)))).first()[0]


@registered(_index_sql())
def folded_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three parts of each day are added; in between the dates of the first half are folded, their
    folders go, and the last part comes late for them."""
    table = _new_table(spark, INDEX_CLICK_COUNT_SUM)
    middle = _middle(fixtures.events(spark, sf_dir))
    hour = F.hour("ts")
    for batch, part in enumerate((hour < 8, (hour >= 8) & (hour < 16), hour >= 16)):
        counts = clicks.running_clicks(_parsed(spark, sf_dir, part=lambda rows, part=part: rows.filter(part)))
        tables.upsert_accumulate(counts, table, batch)
        tables.fold(spark, table, "0000-01-01", middle)
        tables.remove_folded(spark, table)
    return tables.read_table(spark, table)


_DAMAGED = f"""
    SELECT date, position, userid, clickCount + CASE WHEN userid LIKE '%1' THEN 100 ELSE 0 END AS clickCount
    FROM ({_index_sql()}) WHERE NOT userid LIKE '%2'
    UNION ALL
    SELECT date, position, 'x' || userid AS userid, clickCount FROM ({_index_sql()}) WHERE userid LIKE '%3'"""


@registered(f"""
    SELECT * FROM ({_index_sql()}) WHERE date <= ({_HALF})
    UNION ALL SELECT * FROM ({_DAMAGED}) WHERE date > ({_HALF})""")
def repaired_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored counts are altered, lost and made up; those of the first half of the dates are repaired
    from the feed, the others stay as they are."""
    table = _new_table(spark, INDEX_CLICK_COUNT)
    counts = clicks.running_clicks(_parsed(spark, sf_dir))
    tables.upsert_overwrite(counts, table, batch=0, unique=True)
    altered = counts.filter("userid LIKE '%1'").withColumn("clickCount", F.col("clickCount") + 100)
    extra = counts.filter("userid LIKE '%3'").withColumn("userid", F.concat(F.lit("x"), "userid"))
    tables.upsert_overwrite(altered.unionByName(extra), table, batch=1)
    tables.delete_keys(counts.filter("userid LIKE '%2'"), table, batch=2)
    middle = _middle(fixtures.events(spark, sf_dir))
    again = clicks.running_clicks(_parsed(spark, sf_dir, part=lambda rows: rows.filter(date_text(F.col("ts")) <= middle)))
    tables.repair(again, table, 3, "0000-01-01", middle)
    return tables.read_table(spark, table)


@registered(f"""
    SELECT date, userid, adid, CAST(sum(clickCount) AS BIGINT) AS clickCount FROM (
        SELECT * FROM ({_user_ad_sql(_MORNING)}) WHERE userid % 5 <> 0
        UNION ALL SELECT * FROM ({_user_ad_sql(_AFTERNOON)}))
    GROUP BY date, userid, adid""")
def deleted_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of every fifth user are deleted between two batches, the delete is delivered twice, and some
    of the keys come again; then all but the newest batch is folded."""
    rows = _ad_clicks(spark, sf_dir)
    table = _user_ad_table(spark, fixtures.morning(rows))
    for _ in range(2):
        tables.delete_keys(rows.filter("userid % 5 = 0"), table, batch=1)
    tables.upsert_accumulate(ads.user_ad_counts(fixtures.afternoon(rows)), table, batch=2)
    tables.fold(spark, table)
    return tables.read_table(spark, table)


@registered(f"""
    SELECT CAST(0 AS BIGINT) AS run, CAST(0 AS BIGINT) AS batch, CAST(0 AS BIGINT) AS "update", count(*) AS "insert"
    FROM ({_index_sql(_MORNING)})
    UNION ALL
    SELECT CAST(0 AS BIGINT) AS run, CAST(1 AS BIGINT) AS batch, count(b.clickCount) AS "update",
           count(*) - count(b.clickCount) AS "insert"
    FROM ({_index_sql(_AFTERNOON)}) AS n LEFT JOIN ({_index_sql(_MORNING)}) AS b
    ON b.date = n.date AND b.position = n.position AND b.userid = n.userid""")
def affected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys each of two batches updates and inserts, the second one delivered twice."""
    table = _new_table(spark, INDEX_CLICK_COUNT)
    for batch, part in ((0, fixtures.morning), (1, fixtures.afternoon), (1, fixtures.afternoon)):
        counts = clicks.running_clicks(_parsed(spark, sf_dir, part=part))
        tables.upsert_overwrite(counts, table, batch, unique=True, counted=True)
    return tables.affected_rows(spark, table)


@registered(f"""
    SELECT date, position, userid, clickCount FROM ({_index_sql()})
    WHERE position = 'click' AND clickCount >= 2""")
def sql_positional_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = clicks.running_clicks(_parsed(spark, sf_dir))
    return sql.query(
        spark,
        "SELECT date, position, userid, clickCount FROM {counts} WHERE position = ? AND clickCount >= ?",
        ["click", 2],
        counts=counts,
    )


# --- enrichment -----------------------------------------------------------------------------------

VEHICLE_RULES = (
    enrich.Rule("lon > 50", "speaker", "'far'"),
    enrich.Rule("speaker = 'far' AND lat < 20", "mnetworkcode", "'none'"),
)
_VEHICLES_SQL = f"""
    SELECT event_id, date_trunc('second', ts) AS gpstime, value AS lon, CAST(k AS DOUBLE) AS lat,
           CASE WHEN value > 50 THEN 'far' ELSE event_type END AS speaker,
           CASE WHEN value > 50 AND k < 20 THEN 'none' ELSE CAST(user_id AS VARCHAR) END AS mnetworkcode
    FROM ({_EVENTS})"""


def _vehicle_feed(spark: SparkSession, sf_dir: str, plate: bool = False) -> DataFrame:
    rows = fixtures.events(spark, sf_dir)
    records = rows.select(
        F.col("event_id").cast("string").alias("key"),
        F.col("ts").alias("gpstime"),
        F.col("value").alias("lon"),
        F.col("k").cast("double").alias("lat"),
        F.col("event_type").alias("speaker"),
        F.col("user_id").cast("string").alias("mnetworkcode"),
        *([F.concat(F.lit("p"), F.col("event_id").cast("string")).alias("plate")] if plate else []),
    )
    return enrich.to_json_value(records, "key")


@registered(_VEHICLES_SQL)
def enrich_rules_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = enrich.parse_vehicles(jobs.enriched(_vehicle_feed(spark, sf_dir), VEHICLE_RULES))
    return out.select(F.col("key").cast("bigint").alias("event_id"), *VEHICLE_RECORD.names).withColumn(
        "gpstime", F.col("gpstime").cast("timestamp_ntz")
    )


@registered(f"SELECT gpstime, lon, lat, speaker, mnetworkcode, 'p' || event_id AS plate FROM ({_VEHICLES_SQL})")
def publish_value_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enrichment stream from files to files, values only, read back, with a field of no schema."""
    folder = new_run_dir(spark, "enrichment")
    _vehicle_feed(spark, sf_dir, plate=True).write.parquet(f"{folder}/feed")
    query = jobs.start_enrichment(
        feeds.read_clicks(spark, "parquet", path=f"{folder}/feed"),
        VEHICLE_RULES,
        f"{folder}/checkpoint",
        fmt="text",
        path=f"{folder}/topic",
        trigger={"availableNow": True},
    )
    query.awaitTermination()
    out = enrich.parse_vehicles(spark.read.text(f"{folder}/topic"))
    plate = F.from_json(F.concat(F.lit('{"x":'), F.element_at(enrich.UNDECLARED, "plate"), F.lit("}")), "x string")["x"].alias("plate")
    return out.select(F.col("gpstime").cast("timestamp_ntz"), *VEHICLE_RECORD.names[1:], plate)


@registered(f"""
    SELECT event_id, CASE WHEN k < 20 THEN 'malformed' ELSE 'wrong_type' END AS reason
    FROM ({_EVENTS}) WHERE k < 30""")
def enrichment_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broken, array and wrong-type records out of a stream; those with a field more are good."""
    folder = new_run_dir(spark, "enrichment")
    feed = fixtures.damaged_vehicles(fixtures.events(spark, sf_dir))
    feed.select("key", "value").write.parquet(f"{folder}/feed")
    query = jobs.start_enrichment_rejects(
        feeds.read_clicks(spark, "parquet", path=f"{folder}/feed"),
        f"{folder}/rejects",
        f"{folder}/checkpoint",
        {"availableNow": True},
    )
    query.awaitTermination()
    kept = spark.read.parquet(f"{folder}/rejects").join(feed.select("key", "value"), ["key", "value"])
    return kept.select(F.col("key").cast("bigint").alias("event_id"), "reason")


# --- streams --------------------------------------------------------------------------------------

_STREAM_BATCHES = 3


def _stream_session(spark: SparkSession) -> SparkSession:
    """A session with one shuffle partition per core: their number is fixed with the checkpoint."""
    session = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        session.conf.set(name, spark.conf.get(name))
    session.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return session


def _run_available(
    spark: SparkSession, folder: str, table: ResultTable, files_per_batch: int | None = None, **options
) -> None:
    source = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
    feed = feeds.read_clicks(_stream_session(spark), "parquet", source, path=f"{folder}/feed")
    query = jobs.start_click_counts(
        feed,
        table,
        f"{folder}/checkpoint",
        position="click",
        trigger={"availableNow": True},
        **options,
    )
    query.awaitTermination()


def _arrive(rows: DataFrame, folder: str) -> None:
    fixtures.click_feed(rows).select("key", "value").write.mode("append").parquet(f"{folder}/feed")


@registered(_INDEX_CLICKS)
def click_count_stream_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run over a waiting feed in several micro-batches, each handing on every key."""
    folder = new_run_dir(spark, "stream")
    rows = fixtures.events(spark, sf_dir)
    per_file = math.ceil(rows.count() / _STREAM_BATCHES)
    feed = fixtures.click_feed(rows).select("key", "value")
    feed.write.option("maxRecordsPerFile", per_file).parquet(f"{folder}/feed")
    files = len(spark.read.parquet(f"{folder}/feed").inputFiles())
    table = ResultTable(INDEX_CLICK_COUNT, f"{folder}/table")
    files_per_batch = math.ceil(files / _STREAM_BATCHES)
    _run_available(spark, folder, table, files_per_batch, mode="complete")
    return tables.read_table(spark, table)


@registered(_INDEX_CLICKS)
def click_count_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed arrives in three parts; the job is started again for each, from its checkpoint."""
    folder = new_run_dir(spark, "stream")
    rows = fixtures.events(spark, sf_dir)
    table = ResultTable(INDEX_CLICK_COUNT, f"{folder}/table")
    hour = F.hour("ts")
    for part in (hour < 8, (hour >= 8) & (hour < 16), hour >= 16):
        _arrive(rows.filter(part), folder)
        _run_available(spark, folder, table, mode="update")
    return tables.read_table(spark, table)


@registered(_INDEX_CLICKS)
def state_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that a stopped stream holds in its state, read as a table."""
    folder = new_run_dir(spark, "stream")
    rows = fixtures.events(spark, sf_dir)
    table = ResultTable(INDEX_CLICK_COUNT, f"{folder}/table")
    hour = F.hour("ts")
    for part in (hour < 12, hour >= 12):
        _arrive(rows.filter(part), folder)
        _run_available(spark, folder, table, mode="update")
    return jobs.state_counts(spark, f"{folder}/checkpoint")


@registered(f"""
    SELECT date, userid, adid, clickCount FROM ({_user_ad_sql()})
    WHERE userid IN (SELECT user_id FROM events ORDER BY event_id LIMIT 3)""")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored counts of three users out of folded files, which are sorted and have Bloom filters."""
    rows = _ad_clicks(spark, sf_dir)
    table = _user_ad_table(spark, fixtures.morning(rows), fixtures.afternoon(rows))
    tables.upsert_accumulate(ads.user_ad_counts(rows.limit(0)), table, batch=2)
    tables.fold(spark, table)
    users = [r.user_id for r in fixtures.events(spark, sf_dir).orderBy("event_id").limit(3).collect()]
    return tables.read_keys(spark, table, "userid", users)


@registered(_REJECTS)
def rejects_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records with their text, kept in files by a stream."""
    folder = new_run_dir(spark, "rejects")
    feed = fixtures.damaged_feed(fixtures.events(spark, sf_dir))
    feed.select("key", "value").write.parquet(f"{folder}/feed")
    query = jobs.start_rejects(
        feeds.read_clicks(spark, "parquet", path=f"{folder}/feed"),
        f"{folder}/rejects",
        f"{folder}/checkpoint",
        "error",
        {"availableNow": True},
    )
    query.awaitTermination()
    kept = spark.read.parquet(f"{folder}/rejects")
    return kept.select(F.col("key").cast("bigint").alias("event_id"), "reason")


@registered(_INDEX_CLICKS)
def daily_clicks_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed arrives in the order of time, and each part is added to the counts of its days."""
    folder = new_run_dir(spark, "stream")
    rows = fixtures.events(spark, sf_dir)
    table = ResultTable(INDEX_CLICK_COUNT_SUM, f"{folder}/table")
    first, last = rows.agg(F.min("ts").cast("double"), F.max("ts").cast("double")).first()
    third = F.floor((F.col("ts").cast("double") - first) / max(last - first, 1.0) * _STREAM_BATCHES)
    for part in (third < 1, third == 1, third > 1):
        _arrive(rows.filter(part), folder)
        _run_available(spark, folder, table)
    return tables.read_table(spark, table)


@registered(f"""
    SELECT position, count(*) AS pv, count(DISTINCT userid) AS uv, TRUE AS estimate_is_near
    FROM ({_CLICKS}) WHERE date >= ({_HALF}) GROUP BY position""")
def span_visitors_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visitors of a span of dates out of a stream's tables: exactly, and within 5 % by sketches."""
    folder = new_run_dir(spark, "visitors")
    rows = _parsed(spark, sf_dir).select("ts", "date", "position", "userid")
    table, exact = ResultTable(PAGE_VISITORS, f"{folder}/sketches"), ResultTable(INDEX_CLICK_COUNT_SUM, f"{folder}/exact")
    hour = F.hour("ts")
    for part in (hour < 8, (hour >= 8) & (hour < 16), hour >= 16):
        rows.filter(part).write.mode("append").parquet(f"{folder}/feed")
        feed = _stream_session(spark).readStream.schema(rows.schema).parquet(f"{folder}/feed")
        jobs.start_visitors(feed, table, f"{folder}/checkpoint", exact, {"availableNow": True}).awaitTermination()
    middle = _middle(fixtures.events(spark, sf_dir))
    about = clicks.span_visitors(tables.read_table(spark, table), middle, "9999-12-31")
    true = clicks.exact_visitors(tables.read_table(spark, exact), middle, "9999-12-31")
    both = true.join(about.select("position", F.col("pv").alias("_pv"), F.col("uv").alias("_uv")), "position", "left")
    near = (F.col("pv") == F.col("_pv")) & (F.abs(F.col("uv") - F.col("_uv")) <= 0.05 * F.col("uv"))
    return both.select("position", "pv", "uv", F.coalesce(near, F.lit(False)).alias("estimate_is_near"))


_RULES_SQL = f"""
    SELECT gpstime, lon, lat, speaker, mnetworkcode, CAST(1 AS BIGINT) AS rules_version FROM ({_VEHICLES_SQL}) WHERE event_id % 2 = 0
    UNION ALL
    SELECT date_trunc('second', ts) AS gpstime, value AS lon, CAST(k AS DOUBLE) AS lat,
           CASE WHEN k >= 50 THEN 'high' ELSE event_type END AS speaker, CAST(user_id AS VARCHAR) AS mnetworkcode,
           CAST(2 AS BIGINT) AS rules_version
    FROM ({_EVENTS}) WHERE event_id % 2 = 1"""


@registered(_RULES_SQL)
def enrich_stored_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules are changed between two parts of the feed, which stand for two batches."""
    folder = new_run_dir(spark, "enrichment")
    feed = _vehicle_feed(spark, sf_dir)
    number = F.col("key").cast("bigint")
    for part, version in ((number % 2 == 0, VEHICLE_RULES), (number % 2 == 1, (enrich.Rule("lat >= 50", "speaker", "'high'"),))):
        rules.store_rules(spark, f"{folder}/rules", version)
        feed.filter(part).write.mode("append").parquet(f"{folder}/feed")
        query = jobs.start_stored_enrichment(
            feeds.read_clicks(spark, "parquet", path=f"{folder}/feed"),
            f"{folder}/rules",
            f"{folder}/checkpoint",
            fmt="text",
            path=f"{folder}/topic",
            trigger={"availableNow": True},
        )
        query.awaitTermination()
    out = enrich.parse_vehicles(spark.read.text(f"{folder}/topic"))
    version = F.element_at(enrich.UNDECLARED, "rules_version").cast("bigint").alias("rules_version")
    return out.select(F.col("gpstime").cast("timestamp_ntz"), *VEHICLE_RECORD.names[1:], version)


# A click in the year 9000 and a time in milliseconds, both good.
_FAR = ((221845392000, "9000-01-01"), (1704067200000, "55969-09-28"))
_LATE_SQL = f"""
    {_INDEX_CLICKS} UNION ALL
    SELECT date, 'click' AS position, 'far' AS userid, count(*) AS clickCount
    FROM (VALUES {", ".join(f"('{date}')" for _, date in _FAR)}) AS f(date), (SELECT count(*) AS n FROM events)
    WHERE n > 0 GROUP BY date"""


@registered(_LATE_SQL)
def click_count_stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days arrive out of order, times of a far future come first, and one batch is delivered twice."""
    folder = new_run_dir(spark, "stream")
    rows = fixtures.events(spark, sf_dir)
    table = ResultTable(INDEX_CLICK_COUNT_SUM, f"{folder}/table")
    times = F.explode(F.array(*(F.lit(seconds) for seconds, _ in _FAR)))
    content = F.struct(F.lit("click").alias("click_position"))
    far = rows.limit(1).select(F.lit("far").alias("key"), times.alias("timestamp")).select(
        "key", F.to_json(F.struct(F.col("key").alias("user_id"), "timestamp", content.alias("content"))).alias("value")
    )
    far.write.parquet(f"{folder}/feed")
    for part in (F.dayofmonth("ts") % 3 == 2, F.dayofmonth("ts") % 3 == 0, F.dayofmonth("ts") % 3 == 1):
        _arrive(rows.filter(part), folder)
        _run_available(spark, folder, table)
    again = clicks.running_clicks(_parsed(spark, sf_dir, "click", lambda r: r.filter(F.dayofmonth("ts") % 3 == 1)))
    tables.upsert_accumulate(again, table, batch=_STREAM_BATCHES - 1)
    return tables.read_table(spark, table)


def _table_stream(spark: SparkSession, sf_dir: str, spec: TableSpec, counts, position: str | None = "click", **options) -> DataFrame:
    """Ad clicks arrive in three parts, the job is started again for each; what the table then holds."""
    folder = new_run_dir(spark, spec.name)
    rows = _ad_clicks(spark, sf_dir, position)
    table = ResultTable(spec, f"{folder}/table")
    hour = F.hour("ts")
    for part in (hour >= 16, hour < 8, (hour >= 8) & (hour < 16)):
        rows.filter(part).write.mode("append").parquet(f"{folder}/feed")
        feed = _stream_session(spark).readStream.schema(rows.schema).parquet(f"{folder}/feed")
        query = jobs.start_table(feed, counts, table, f"{folder}/checkpoint", trigger={"availableNow": True}, **options)
        query.awaitTermination()
    return tables.read_table(spark, table)


@registered(_user_ad_sql())
def user_ad_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_stream(spark, sf_dir, AD_USER_CLICK_COUNT, ads.user_ad_counts)


@registered(_trend_sql("event_type = 'click'"))
def minute_ad_counts_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table_stream(spark, sf_dir, AD_CLICK_TREND_SUM, ads.minute_ad_counts)


@registered(ORACLE["hourly_pv"])
def hourly_pv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored_views = _table_stream(spark, sf_dir, HOURLY_PV, clicks.hourly_counts, position=None)
    return stored_views.select("datehour", F.col("clickCount").alias("pv"))


@registered(_top3_sql(_AD_CLICKS))
def province_top3_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch adds to the counts per region, and the top ads of its dates are taken anew."""
    top = _new_table(spark, AD_PROVINCE_TOP3)
    _table_stream(
        spark,
        sf_dir,
        AD_STAT_SUM,
        lambda batch: _region_counts(batch.sparkSession, sf_dir, batch),
        top=top,
    )
    return tables.read_table(spark, top)
