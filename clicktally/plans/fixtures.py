"""The given tables in the shape of a click feed.

``props`` holds a number ``k`` from 0 to 99. An ad is ten of them. Users with ``k`` below 5 are
anonymous: below 2 their id is empty, below 5 it is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clicktally.functions.columns import date_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``ts`` as an instant and ``k`` out of ``props``."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", k.alias("k")
    )


def click_json(rows: DataFrame, user: Column) -> Column:
    content = F.struct(F.col("event_type").alias("click_position"))
    return F.to_json(
        F.struct(
            user.alias("user_id"), F.unix_timestamp("ts").alias("timestamp"), content.alias("content")
        )
    )


def click_feed(rows: DataFrame) -> DataFrame:
    """Click records as JSON text in ``value``, with ``event_id`` beside it and as the ``key``."""
    value = F.when(F.col("k") < 2, click_json(rows, F.lit(""))).otherwise(
        click_json(rows, F.when(F.col("k") >= 5, F.col("user_id")))
    )
    key = F.col("event_id").cast("string").alias("key")
    return rows.select("event_id", "ts", key, value.alias("value"))


def damaged_feed(rows: DataFrame) -> DataFrame:
    """The click feed with broken ``error`` records, and bad times in some ``view`` records."""
    good = click_json(rows, F.col("user_id"))
    no_content = F.to_json(F.struct("user_id", F.unix_timestamp("ts").alias("timestamp")))
    text_content = F.to_json(F.struct("user_id", F.lit("text").alias("content")))
    content = F.struct(F.col("event_type").alias("click_position"))
    bad_time = F.to_json(F.struct("user_id", F.lit("n/a").alias("timestamp"), content.alias("content")))
    error = F.col("event_type") == "error"
    k = F.col("k")
    value = (
        F.when(error & (k < 20), F.concat(F.lit("{"), F.col("good")))
        .when(error & (k < 40), F.col("no_content"))
        .when(error & (k < 60), F.col("text_content"))
        .when((error & (k < 80)) | ((F.col("event_type") == "view") & (k < 10)), F.col("bad_time"))
        .otherwise(F.col("good"))
    )
    texts = rows.select(
        "event_id",
        "event_type",
        "k",
        good.alias("good"),
        no_content.alias("no_content"),
        text_content.alias("text_content"),
        bad_time.alias("bad_time"),
    )
    return texts.select("event_id", F.col("event_id").cast("string").alias("key"), value.alias("value"))


def ad_clicks(rows: DataFrame) -> DataFrame:
    """Ad clicks by date, hour, minute, user and ad."""
    return rows.select(
        "event_id",
        "ts",
        F.col("event_type").alias("position"),
        date_text(F.col("ts")).alias("date"),
        F.date_format("ts", "HH").alias("hour"),
        F.date_format("ts", "mm").alias("minute"),
        F.col("user_id").alias("userid"),
        F.floor(F.col("k") / 10).alias("adid"),
    )


def damaged_vehicles(rows: DataFrame) -> DataFrame:
    """Enrichment records of which some are no JSON, no object, of a wrong type or have a field more."""
    k, n = F.col("k"), F.col("value").cast("string")
    text = (
        F.when(k < 10, F.concat(F.lit("no json "), n))
        .when(k < 20, F.concat(F.lit("["), n, F.lit("]")))
        .when(k < 30, F.concat(F.lit('{"lat":1.5,"lon":"east '), n, F.lit('"}')))
        .when(k < 60, F.concat(F.lit('{"lat":1.5,"plate":"p'), k.cast("string"), F.lit('","seats":[1,2]}')))
        .otherwise(F.concat(F.lit('{"lat":1.5,"speaker":"s'), k.cast("string"), F.lit('"}')))
    )
    return rows.select("event_id", F.col("event_id").cast("string").alias("key"), text.alias("value"))


def user_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``userid, province, city`` of every customer. Nations and regions are fixed lists of 25 and 5."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    cities = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    cities = cities.select("n_nationkey", F.col("r_name").alias("province"), F.col("n_name").alias("city"))
    customers = table(spark, sf_dir, "customer")
    return customers.join(cities, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("userid"), "province", "city"
    )


def morning(rows: DataFrame) -> DataFrame:
    return rows.filter(F.hour("ts") < 12)


def afternoon(rows: DataFrame) -> DataFrame:
    return rows.filter(F.hour("ts") >= 12)
