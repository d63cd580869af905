"""Declared schemas: the JSON records that come in and the tables that are kept."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

_TEXT = StringType()
_LONG = LongType()


def _struct(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


# Fixed values of the click feed.
APP_RESTART = "app_restart"
ANONYMOUS_USER = "-99"
KEY_SEPARATOR = "|"
DATE_FORMAT = "yyyy-MM-dd"
DATE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
MAX_EPOCH_SECONDS = 9_223_372_036_854  # the last whole second that a TIMESTAMP holds

# A feed record as it arrives: the text key and value of a message.
FEED = _struct(key=_TEXT, value=_TEXT)

# The fields the counting job needs. Every leaf is text, so numbers and quoted numbers both parse.
# The last field receives a text that is not JSON or not of this shape.
CLICK_FIELDS = _struct(
    user_id=_TEXT,
    timestamp=_TEXT,
    content=_struct(click_position=_TEXT),
    _corrupt_record=_TEXT,
)

# The whole click record, for jobs that want more than the counts.
CLICK_RECORD = _struct(
    user_id=_TEXT,
    user_ipaddress=_TEXT,
    timestamp=_TEXT,
    referer=_TEXT,
    url=_TEXT,
    location=_TEXT,
    device=_TEXT,
    content=_struct(
        user_id=_TEXT, click_position=_TEXT, deviceID=_TEXT, gid=_TEXT, ver=_TEXT
    ),
    _corrupt_record=_TEXT,
)

# The enrichment record; the types are ours.
VEHICLE_RECORD = _struct(
    gpstime=TimestampType(),
    lon=DoubleType(),
    lat=DoubleType(),
    speaker=_TEXT,
    mnetworkcode=_TEXT,
)


@dataclass(frozen=True)
class TableSpec:
    """A kept table: its columns, its key and how later batches meet earlier ones.

    ``merge`` is one of

    * ``append``: every row of every batch stays,
    * ``latest``: the newest batch that holds a key gives its count,
    * ``sum``: the counts of all batches add up per key,
    * ``group``: the newest batch that holds a key group gives all its rows,
    * ``sketch``: counts add up and the sketches of ``visitors`` unite per key.
    """

    name: str
    schema: StructType
    keys: tuple[str, ...]
    merge: str

    @property
    def partition_columns(self) -> list[str]:
        return ["date"] if "date" in self.schema.names else []


INDEX_CLICK_COUNT = TableSpec(
    "index_gid_click_count",
    _struct(date=_TEXT, position=_TEXT, userid=_TEXT, clickCount=_LONG),
    ("date", "position", "userid"),
    "latest",
)
INDEX_CLICK_COUNT_ROWS = TableSpec(
    INDEX_CLICK_COUNT.name, INDEX_CLICK_COUNT.schema, INDEX_CLICK_COUNT.keys, "append"
)
# The same table kept by what each batch adds: no state, and a late record counts like any other.
INDEX_CLICK_COUNT_SUM = TableSpec(
    INDEX_CLICK_COUNT.name, INDEX_CLICK_COUNT.schema, INDEX_CLICK_COUNT.keys, "sum"
)
HOURLY_PV = TableSpec(
    "hourly_pv", _struct(date=_TEXT, datehour=_TEXT, clickCount=_LONG), ("date", "datehour"), "sum"
)
# Page views, and a sketch of who came: sketches of any dates unite.
PAGE_VISITORS = TableSpec(
    "page_visitors",
    _struct(date=_TEXT, position=_TEXT, clickCount=_LONG, visitors=BinaryType()),
    ("date", "position"),
    "sketch",
)
AD_BLACKLIST = TableSpec("ad_blacklist", _struct(userid=_LONG), (), "append")
AD_USER_CLICK_COUNT = TableSpec(
    "ad_user_click_count",
    _struct(date=_TEXT, userid=_LONG, adid=_LONG, clickCount=_LONG),
    ("date", "userid", "adid"),
    "sum",
)
AD_STAT = TableSpec(
    "ad_stat",
    _struct(date=_TEXT, province=_TEXT, city=_TEXT, adid=_LONG, clickCount=_LONG),
    ("date", "province", "city", "adid"),
    "latest",
)
AD_STAT_SUM = TableSpec(AD_STAT.name, AD_STAT.schema, AD_STAT.keys, "sum")
AD_PROVINCE_TOP3 = TableSpec(
    "ad_province_top3",
    _struct(date=_TEXT, province=_TEXT, adid=_LONG, clickCount=_LONG),
    ("date", "province"),
    "group",
)
AD_CLICK_TREND = TableSpec(
    "ad_click_trend",
    _struct(date=_TEXT, hour=_TEXT, minute=_TEXT, adid=_LONG, clickCount=_LONG),
    ("date", "hour", "minute", "adid"),
    "latest",
)
AD_CLICK_TREND_SUM = TableSpec(
    AD_CLICK_TREND.name, AD_CLICK_TREND.schema, AD_CLICK_TREND.keys, "sum"
)

TABLES = {
    spec.name: spec
    for spec in (
        INDEX_CLICK_COUNT,
        AD_BLACKLIST,
        AD_USER_CLICK_COUNT,
        AD_STAT,
        AD_PROVINCE_TOP3,
        AD_CLICK_TREND,
    )
}
