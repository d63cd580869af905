"""Click records: parsing, filtering, rejects and counts.

Everything here takes and returns DataFrames and works on batch and streaming input alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clicktally.functions.columns import date_text, epoch_timestamp, user_or_anonymous
from clicktally.schemas import APP_RESTART, CLICK_FIELDS, HOURLY_PV


def read_json(df: DataFrame, schema: StructType, value: str = "value", **options: str) -> DataFrame:
    """Replace the JSON text in ``value`` by the declared fields, keeping the other columns.

    The fields come out of a generator, which keeps a later filter from being pushed below the
    parse: that would parse the text twice, once for the filter and once for the projection.
    """
    parsed = F.from_json(
        F.col(value), schema, {"allowUnquotedFieldNames": "true", **options}
    )
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.inline(F.array(parsed)))


def parse_clicks(df: DataFrame, value: str = "value") -> DataFrame:
    """Click fields ``ts, position, userid`` from JSON text, next to the other columns.

    ``content_missing`` and ``malformed`` tell why a record has no fields; see :func:`rejects`.
    """
    fields = read_json(df, CLICK_FIELDS, value)
    others = [c for c in df.columns if c != value]
    return fields.select(
        *others,
        epoch_timestamp(F.col("timestamp")).alias("ts"),
        F.col("content.click_position").alias("position"),
        user_or_anonymous(F.col("user_id")).alias("userid"),
        F.col("content").isNull().alias("content_missing"),
        F.col("_corrupt_record").isNotNull().alias("malformed"),
    )


def _has_position(position: str | None) -> Column:
    named = F.col("position").isNotNull()
    return named if position is None else F.col("position") == position


def filter_position(clicks: DataFrame, position: str | None = APP_RESTART) -> DataFrame:
    """Clicks at exactly this position; records without a position go. ``None`` keeps every position."""
    return clicks.filter(_has_position(position))


def countable(parsed: DataFrame, position: str | None = APP_RESTART) -> DataFrame:
    """The parsed clicks that count: at the wanted position and with a valid time."""
    kept = filter_position(parsed, position).filter(F.col("ts").isNotNull())
    return kept.withColumn("date", date_text(F.col("ts"))).drop("content_missing", "malformed")


def rejects(parsed: DataFrame, position: str | None = APP_RESTART) -> DataFrame:
    """The records that cannot be judged, with a ``reason``.

    A record at another position is an ordinary drop, whatever its time looks like.
    """
    reason = (
        F.when(F.col("malformed") & F.col("content_missing"), "malformed")
        .when(F.col("content_missing"), "no_content")
        .when(_has_position(position) & F.col("ts").isNull(), "bad_timestamp")
    )
    return parsed.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def count_clicks(clicks: DataFrame, *keys: str) -> DataFrame:
    """Clicks per key: one for each row."""
    return clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("clickCount"))


def sum_counts(counts: DataFrame, *keys: str) -> DataFrame:
    """Counts of a finer grain, summed per key."""
    return counts.groupBy(*keys).agg(F.sum("clickCount").alias("clickCount"))


def running_clicks(clicks: DataFrame) -> DataFrame:
    """Click count per date, position and user; on a stream, the count so far.

    Output mode ``complete`` gives every key each time, ``update`` the touched keys only.
    """
    return count_clicks(clicks, "date", "position", "userid")


def _datehour() -> Column:
    return F.concat(date_text(F.col("ts")), F.date_format(F.col("ts"), " HH"))


def hourly_pv(clicks: DataFrame) -> DataFrame:
    """Page views per ``yyyy-MM-dd HH``."""
    return clicks.groupBy(_datehour().alias("datehour")).agg(F.count(F.lit(1)).alias("pv"))


def hourly_counts(clicks: DataFrame) -> DataFrame:
    """The rows of the kept table of hourly page views, ``clickCount`` being the views."""
    return count_clicks(clicks.withColumn("datehour", _datehour()), *HOURLY_PV.keys)


def page_pv_uv(counts: DataFrame) -> DataFrame:
    """Page views and unique visitors per date and position, from one row per date, position, user.

    The anonymous user counts as one visitor. As the key makes users distinct, no further
    ``DISTINCT`` is needed and a hot page is reduced before the shuffle.
    """
    return counts.groupBy("date", "position").agg(
        F.sum("clickCount").alias("pv"), F.count("userid").alias("uv")
    )


#: Sketches have 2 to this power of buckets: an error of about 1.6 %, and 4 KB at most.
SKETCH_LOG = 12


def visitor_sketches(counts: DataFrame) -> DataFrame:
    """Page views and a HyperLogLog sketch of the visitors per date and position, from counts per user."""
    return counts.groupBy("date", "position").agg(
        F.sum("clickCount").alias("clickCount"), F.hll_sketch_agg("userid", SKETCH_LOG).alias("visitors")
    )


def span_visitors(sketches: DataFrame, first: str, last: str) -> DataFrame:
    """Page views, and about how many different visitors, per position in the dates ``first`` to ``last``."""
    rows = sketches.filter(F.col("date").between(first, last))
    return rows.groupBy("position").agg(
        F.sum("clickCount").alias("pv"), F.hll_sketch_estimate(F.hll_union_agg("visitors")).alias("uv")
    )


def exact_visitors(counts: DataFrame, first: str, last: str) -> DataFrame:
    """The same from counts per user, exactly: users are made distinct before they are counted."""
    rows = counts.filter(F.col("date").between(first, last))
    users = rows.groupBy("position", "userid").agg(F.sum("clickCount").alias("clickCount"))
    return users.groupBy("position").agg(F.sum("clickCount").alias("pv"), F.count("userid").alias("uv"))
