"""Ad click statistics. The kept ad tables come with the feed; how to fill them is ours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicktally.operators.clicks import count_clicks, sum_counts
from clicktally.operators.joins import SALTS, filtered_join, hot_key_join
from clicktally.schemas import AD_CLICK_TREND, AD_STAT, AD_USER_CLICK_COUNT


def user_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per date, user and ad."""
    return count_clicks(clicks, *AD_USER_CLICK_COUNT.keys)


def region_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per date, province, city and ad."""
    return count_clicks(clicks, *AD_STAT.keys)


def region_ad_sums(counts: DataFrame) -> DataFrame:
    """The same from counts of a finer grain."""
    return sum_counts(counts, *AD_STAT.keys)


def minute_ad_counts(clicks: DataFrame) -> DataFrame:
    """Clicks per date, hour, minute and ad."""
    return count_clicks(clicks, *AD_CLICK_TREND.keys)


def province_top_ads(region_counts: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most clicked ads per date and province; equal counts go by the smaller ad id.

    Spark applies the rank limit before the shuffle too, so each task passes on ``n`` rows a group.
    """
    per_province = sum_counts(region_counts, "date", "province", "adid")
    order = Window.partitionBy("date", "province").orderBy(F.desc("clickCount"), "adid")
    ranked = per_province.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= n).select("date", "province", "adid", "clickCount")


def with_region(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """Add ``province, city`` to counts per user; users without a region are left out, see
    :func:`without_region`.

    Give counts, not clicks: a busy user is then one row per day and ad and no hot key.
    """
    return counts.join(regions, "userid")


def without_region(counts: DataFrame, regions: DataFrame) -> DataFrame:
    """The counts that :func:`with_region` leaves out, as rejects."""
    return counts.join(regions.select("userid"), "userid", "left_anti")


def users_over(user_ad: DataFrame, threshold: int) -> DataFrame:
    """Users with more than ``threshold`` clicks on one ad in one day."""
    return user_ad.filter(F.col("clickCount") > threshold).select("userid").distinct()


def drop_blacklisted(
    clicks: DataFrame, blacklist: DataFrame, salts: int = SALTS, prefilter: bool = False
) -> DataFrame:
    """The clicks of users that are not on the blacklist; user ids may be numbers or text.

    With ``prefilter``, for a list too long to be broadcast and far more clicks, the clicks of users
    that a Bloom filter of the list excludes stay where they are, and only the others are joined.

    A stream would go on with the list as it was at its start: it is refused here. Streams read the
    list anew for each batch, see ``clicktally.streaming.jobs.start_table``.
    """
    if clicks.isStreaming:
        raise ValueError("a stream needs the list anew for each batch: use start_table(..., blacklist=...)")
    listed = blacklist.select(F.col("userid").cast(clicks.schema["userid"].dataType)).distinct()
    join = filtered_join if prefilter else hot_key_join
    return join(clicks, listed, ["userid"], "left_anti", salts)
