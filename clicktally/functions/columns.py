"""Column expressions of the click feed. All of them are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clicktally.schemas import (
    ANONYMOUS_USER,
    DATE_FORMAT,
    DATE_TIME_FORMAT,
    KEY_SEPARATOR,
    MAX_EPOCH_SECONDS,
)


def epoch_seconds(text: Column) -> Column:
    """A whole number as BIGINT; null if it is none or no TIMESTAMP can hold it.

    Milliseconds are taken as the far future that they say; they are counted under that date.
    """
    seconds = text.try_cast("bigint")
    return F.when(seconds.between(-MAX_EPOCH_SECONDS, MAX_EPOCH_SECONDS), seconds)


def epoch_timestamp(text: Column) -> Column:
    """Epoch seconds given as text, as a TIMESTAMP; null if they are not valid."""
    return F.timestamp_seconds(epoch_seconds(text))


def _plain_year(text: Column) -> Column:
    """Spark writes years of more than four digits with a plus sign."""
    return F.ltrim(text, F.lit("+"))


def date_text(ts: Column) -> Column:
    """Calendar date in the session time zone."""
    return _plain_year(F.date_format(ts, DATE_FORMAT))


def date_time_text(ts: Column) -> Column:
    return _plain_year(F.date_format(ts, DATE_TIME_FORMAT))


def user_or_anonymous(user: Column) -> Column:
    """A null or empty user becomes the anonymous one; a blank stays as it is."""
    return F.coalesce(F.nullif(user, F.lit("")), F.lit(ANONYMOUS_USER))


def click_key(date: Column, position: Column, user: Column) -> Column:
    """The one-text form of a click key, for consumers that still want it."""
    return F.concat_ws(KEY_SEPARATOR, date, position, user)


def click_key_part(key: Column, index: int) -> Column:
    """Part ``index`` of a one-text click key, null past its end."""
    return F.get(F.split(key, f"\\{KEY_SEPARATOR}"), F.lit(index))
