"""New rows against what a table already holds.

``stored`` is a table as :func:`clicktally.sources.tables.read_table` returns it, with one row per
key. Both sides are then grouped by the key, so the joins below need no shuffle of their own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _beside(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    known = stored.select(*keys, F.col("clickCount").alias("_stored"), F.lit(True).alias("_known"))
    return new.join(known, list(keys), "left")


def changed_only(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Leave out the rows whose key is stored with the same count."""
    same = F.col("_known") & F.col("_stored").eqNullSafe(F.col("clickCount"))
    both = _beside(new, stored, keys)
    return both.filter(~F.coalesce(same, F.lit(False))).select(*new.columns)


def split_by_key(new: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark each new row as an ``update`` of a stored key or an ``insert``, in column ``action``."""
    action = F.when(F.col("_known"), "update").otherwise("insert").alias("action")
    return _beside(new, stored, keys).select(*new.columns, action)


def lookup_counts(wanted: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The stored count of every wanted key, 0 if there is none.

    Wanted keys are a set: repeats are combined before the shuffle and give one row.
    """
    wanted_keys = wanted.select(*keys).distinct()
    count = F.coalesce(F.col("_stored"), F.lit(0).cast("bigint")).alias("clickCount")
    return _beside(wanted_keys, stored, keys).select(*keys, count)
