"""Enrichment rules kept outside of the job, in versions.

Every version is a folder with all of its rules, written once and never changed. A rule is tried on an
empty record before it is stored, so a broken one is refused there and stops no stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from clicktally.config import if_exists
from clicktally.operators.enrich import Rule
from clicktally.schemas import VEHICLE_RECORD

_STORED = "version bigint, place int, predicate string, column string, value string"


def check_rules(records: DataFrame, rules: Iterable[Rule]) -> None:
    """Fail with the place of the first rule that does not fit the records."""
    for place, rule in enumerate(rules):
        if rule.column not in records.columns:
            raise ValueError(f"rule {place}: there is no column {rule.column!r}")
        try:
            kind = records.select(F.expr(rule.predicate).alias("p")).schema["p"].dataType
            records.select(F.expr(rule.value).cast(records.schema[rule.column].dataType)).schema  # noqa: B018  is resolved here
        except (AnalysisException, ParseException) as err:
            raise ValueError(f"rule {place}: {str(err).splitlines()[0]}") from err
        if not isinstance(kind, BooleanType):
            raise ValueError(f"rule {place}: the predicate is {kind.simpleString()}, not boolean")


def _every(spark: SparkSession, path: str) -> DataFrame:
    found = if_exists(lambda: spark.read.schema(_STORED).parquet(path))
    return spark.createDataFrame([], _STORED) if found is None else found


def newest_version(spark: SparkSession, path: str) -> int:
    """0 if no rules are stored."""
    return _every(spark, path).agg(F.max("version")).first()[0] or 0


def store_rules(spark: SparkSession, path: str, rules: Iterable[Rule]) -> int:
    """Store all rules as the next version, and return it. Two writers can't store the same version."""
    rules = list(rules)
    if not rules:
        raise ValueError("a version has one rule at least; store one that never holds to end all others")
    check_rules(spark.createDataFrame([], VEHICLE_RECORD), rules)
    version = newest_version(spark, path) + 1
    rows = [(place, *rule) for place, rule in enumerate(rules)]
    table = spark.createDataFrame(rows, "place int, predicate string, column string, value string")
    table.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")
    return version


def read_rules(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, list[Rule]]:
    """A version (the newest one) and its rules in order: a short list, kept by people."""
    version = newest_version(spark, path) if version is None else version
    rows = _every(spark, path).filter(F.col("version") == version).orderBy("place").collect()
    if version and not rows:
        raise ValueError(f"{path} has no version {version}")
    return version, [Rule(r.predicate, r.column, r.value) for r in rows]
