"""Rule-based enrichment of JSON records."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, TimestampType

from clicktally.schemas import DATE_TIME_FORMAT, VEHICLE_RECORD

_OPTIONS = {"allowUnquotedFieldNames": "true"}


class Rule(NamedTuple):
    """Where ``predicate`` holds, ``column`` becomes ``value``; both are SQL expressions."""

    predicate: str
    column: str
    value: str


# Fields of a record that the schema does not name: the JSON text of each value, numbers spelled as they
# came (inside lists and objects with the same value).
UNDECLARED = "undeclared"

_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
# How every JSON value begins that is not a string.
_LITERAL = r"^(-?[0-9]|\[|\{|true$|false$)"


def _typed(text: Column, kind: DataType) -> Column:
    """A declared field from its text, null if it is not of the type; numbers may be quoted."""
    if isinstance(kind, DoubleType):
        return F.when(text.rlike(_NUMBER), text.cast(kind))
    if isinstance(kind, TimestampType):
        whole = F.when(text.rlike("^-?[0-9]{1,12}$"), F.timestamp_seconds(text.cast("bigint")))
        return F.coalesce(whole, F.try_to_timestamp(text, F.lit(DATE_TIME_FORMAT)))
    return text


def _quoted(text: Column) -> Column:
    inside = F.to_json(F.array(text))
    return F.substring(inside, F.lit(2), F.length(inside) - 2)


def _undeclared(fields: Column, value: Column) -> Column:
    """The JSON texts of the fields that the schema does not name.

    A text that looks like no string may still be one, ``"1"`` for example: only records with such a
    text are read once more, for the types.
    """
    others = F.map_filter(fields, lambda k, _: ~k.isin(*VEHICLE_RECORD.names))
    doubtful = F.exists(F.map_values(others), lambda v: v.rlike(_LITERAL))
    kinds = F.when(doubtful, F.from_json(value, "map<string,variant>", _OPTIONS))

    def spelled(k: Column, v: Column) -> Column:
        """A number with a fraction or an exponent, which the parser has written its own way."""
        name = F.concat(F.lit(r'[{,]\s*"?\Q'), k, F.lit(r'\E"?\s*:\s*(-?[0-9][0-9.eE+-]*)'))
        found = F.get(F.regexp_extract_all(value, name, F.lit(1)), 0)
        same = found.try_cast("double").eqNullSafe(v.try_cast("double"))
        return F.when(v.rlike("^-?[0-9]+[.eE]") & same, found).otherwise(v)

    def written(k: Column, v: Column) -> Column:
        is_text = F.coalesce(F.schema_of_variant(F.try_element_at(kinds, k)) == "STRING", F.lit(False))
        return F.when(v.isNull(), "null").when(v.rlike(_LITERAL) & ~is_text, spelled(k, v)).otherwise(_quoted(v))

    return F.when(F.size(F.map_keys(fields)) > 0, F.transform_values(others, written))


def read_vehicles(df: DataFrame, value: str = "value") -> DataFrame:
    """Enrichment records from JSON text, next to the other columns, with a ``reason`` for bad ones.

    ``malformed`` is a text that is no JSON object, ``wrong_type`` an object with a field that is not
    of the declared type. ``undeclared`` holds all other fields. The text is parsed once: the fields
    come out of a generator, which keeps them from being parsed again for each column.
    """
    fields = F.from_json(F.col(value), "map<string,string>", _OPTIONS)
    rows = df.select(*df.columns, F.explode(F.array(fields)).alias("_fields"))
    texts = {f.name: F.try_element_at("_fields", F.lit(f.name)) for f in VEHICLE_RECORD.fields}
    typed = {f.name: _typed(texts[f.name], f.dataType) for f in VEHICLE_RECORD.fields}
    wrong = F.lit(False)
    for name, text in texts.items():
        wrong = wrong | (text.isNotNull() & typed[name].isNull())
    reason = F.when(F.col("_fields").isNull(), "malformed").when(wrong, "wrong_type")
    return rows.select(
        *(c for c in df.columns if c != value),
        *(column.alias(name) for name, column in typed.items()),
        _undeclared(F.col("_fields"), F.col(value)).alias(UNDECLARED),
        reason.alias("reason"),
    )


def parse_vehicles(df: DataFrame, value: str = "value") -> DataFrame:
    """The good enrichment records from JSON text, next to the other columns; see :func:`vehicle_rejects`."""
    return read_vehicles(df, value).filter(F.col("reason").isNull()).drop("reason")


def vehicle_rejects(df: DataFrame, value: str = "value") -> DataFrame:
    """The records that are no good, with their text and a ``reason``, next to the other columns."""
    kept = read_vehicles(df.withColumn("_text", F.col(value)), value).filter(F.col("reason").isNotNull())
    others = [c for c in df.columns if c != value]
    return kept.select(*others, F.col("_text").alias(value), "reason")


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Apply rules in order; a rule sees what earlier rules wrote and keeps the column's type."""
    for rule in rules:
        old = F.col(rule.column)
        new = F.expr(rule.value).cast(df.schema[rule.column].dataType)
        df = df.withColumn(rule.column, F.when(F.expr(rule.predicate), new).otherwise(old))
    return df


def to_json_value(df: DataFrame, *keep: str) -> DataFrame:
    """All columns but ``keep`` as JSON text in ``value``, with times to the second; fields that were
    not declared follow as they came."""
    fields = [c for c in df.columns if c not in (*keep, UNDECLARED)]
    text = F.to_json(F.struct(*fields), {"timestampFormat": DATE_TIME_FORMAT})
    if UNDECLARED in df.columns:
        pairs = F.transform(F.map_entries(UNDECLARED), lambda e: F.concat(_quoted(e["key"]), F.lit(":"), e["value"]))
        more = F.concat(F.concat_ws(",", pairs), F.lit("}"))
        text = (
            F.when(F.coalesce(F.size(UNDECLARED), F.lit(0)) <= 0, text)
            .when(text == "{}", F.concat(F.lit("{"), more))
            .otherwise(F.concat(F.substring(text, F.lit(1), F.length(text) - 1), F.lit(","), more))
        )
    return df.select(*keep, text.alias("value"))
