"""How quality filters interact: what each of them removes in every order they can be applied in.

A document's failures are a mask of bits, one per filter. Documents are counted per part (language)
and mask: at most ``2 ** filters`` cells a part, whatever the number of documents. Each cell then
folds across the array of all orders, which travels with the plan: ``transform`` goes through the
orders and ``aggregate`` through the filters of one, with what has removed the cell's documents so
far. Five filters make 600 structs a cell, weighted by its counts; the cells of a part are merged by
sums, element by element.

Built-in functions only. Defined results: a null text is empty, a null language the part ``''``; an
empty or null text has no words, and fails A only (and E, if an earlier document is empty too);
rows that repeat an id are counted one by one and are no copies of each other; a row without id is
no copy and nothing is a copy of it; a document without label, or with a label of null, is neither
good nor toxic, and one of several labels for an id is enough; no documents give no rows. Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The filters, in the order of their bits.
FILTERS = "ABCDE"
#: Over so many tasks rows without id are spread, where ids are joined.
SALTS = 256

_COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures(text: Column) -> Column:
    """Bits of the filters that look at one text: A, B, C and D."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    fails = [
        F.size(words) < 200,
        100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        100 * (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) > 3 * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(fail, 1 << i).otherwise(0) for i, fail in enumerate(fails)]
    return (bits[0] + bits[1] + bits[2] + bits[3]).cast("int")


def measure(docs: DataFrame) -> DataFrame:
    """``doc_id, part, digest, mask`` of every document, without the filter that compares documents."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce("lang", F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text_failures(text).alias("mask"),
    )


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with ``good`` and ``toxic``, 0 or 1; those without id are spread and meet no label."""
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("bigint")).alias("good"), F.max((F.col("toxic") == 1).cast("bigint")).alias("toxic")
    )
    salt = F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64("digest"), F.lit(SALTS))).otherwise(0).alias("salt")
    found = rows.select("*", salt).join(marks.withColumn("salt", F.lit(0).cast("bigint")), ["doc_id", "salt"], "left")
    zero = F.lit(0).cast("bigint")
    return found.withColumns({"good": F.coalesce("good", zero), "toxic": F.coalesce("toxic", zero)})


def count_cells(measured: DataFrame, labels: DataFrame, copy_bit: int = 4) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by part and failures, copies of a smaller id included.

    Repeated rows are counted before they are joined, and all copies of a text in a part are one row
    per task before they are compared, so a large group of copies is no hot key.
    """
    rows = measured.groupBy("doc_id", "part", "digest", "mask").agg(F.count("*").alias("n"))
    rows = _labelled(rows, labels).withColumns({"good": F.col("n") * F.col("good"), "toxic": F.col("n") * F.col("toxic")})
    sums = ("n", "good", "toxic")
    nameless = F.col("doc_id").isNull()
    texts = rows.groupBy("digest", "part", "mask").agg(
        F.min(F.when(~nameless, F.struct("doc_id", *sums))).alias("first"),
        *(F.sum(x).alias(x) for x in sums),
        *(F.sum(F.when(nameless, F.col(x)).otherwise(0)).alias(f"free_{x}") for x in sums),
    )
    leads = F.col("first.doc_id") == F.min("first.doc_id").over(Window.partitionBy("digest"))
    texts = texts.withColumn("leads", F.coalesce(leads, F.lit(False)))

    def original(x: str) -> Column:
        return F.col(f"free_{x}") + F.when(F.col("leads"), F.col(f"first.{x}")).otherwise(0)

    both = F.array(
        F.struct("mask", *(original(x).alias(x) for x in sums)),
        F.struct(F.col("mask").bitwiseOR(F.lit(1 << copy_bit)).alias("mask"), *((F.col(x) - original(x)).alias(x) for x in sums)),
    )
    cells = texts.select("part", F.inline(both)).where("n > 0")
    return cells.groupBy("part", "mask").agg(*(F.sum(x).alias(x) for x in sums))


def _fold(cell: Column, orders: Column) -> Column:
    """A struct for every order and step: what the step does to the cell's documents."""
    zero = F.lit(0).cast("bigint")

    def step(state: Column, bit: Column) -> Column:
        fails = F.getbit(cell["mask"], bit) == 1
        goes = fails & ~state["gone"]

        def when(condition: Column, x: str) -> Column:
            return F.when(condition, cell[x]).otherwise(zero)

        counts = F.struct(
            bit.alias("bit"),
            when(~fails & ~state["gone"], "n").alias("kept"),
            when(goes, "n").alias("removed"),
            when(fails & state["gone"], "n").alias("redundant"),
            when(fails & (F.bit_count(cell["mask"]) == 1), "n").alias("unique_fails"),
            when(goes, "good").alias("good_lost"),
            when(goes, "toxic").alias("toxic_lost"),
        )
        return F.struct((state["gone"] | fails).alias("gone"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    kind = "array<struct<bit:int," + ",".join(f"{c}:bigint" for c in _COUNTS) + ">>"
    start = F.struct(F.lit(False).alias("gone"), F.array().cast(kind).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def audit(cells: DataFrame, filters: Sequence[str] = FILTERS) -> DataFrame:
    """A row per part, order of the filters and step, from counts per part and mask.

    ``cells`` has ``part, mask, n, good, toxic`` with one bit of the mask per filter. ``kept`` are left
    after the step, ``removed`` go in it, ``redundant`` fail its filter but went before, ``unique_fails``
    fail no other filter; ``shapley`` is what its filter removes, over all orders.
    """
    names = list(filters)
    every = list(permutations(range(len(names))))
    orders = F.array(*(F.array(*(F.lit(i) for i in order)) for order in every))
    # 2 ** filters cells at most
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))

    def add(x: Column, y: Column) -> Column:
        return F.struct(y["bit"].alias("bit"), *((x[c] + y[c]).alias(c) for c in _COUNTS))

    nothing = F.struct(F.lit(0).alias("mask"), *(F.lit(0).cast("bigint").alias(x) for x in ("n", "good", "toxic")))
    merged = F.aggregate(
        "cells", _fold(nothing, orders), lambda sums, cell: F.zip_with(sums, _fold(cell, orders), add)
    )
    parts = parts.select("part", merged.alias("steps"))

    def removed(bit: int) -> Column:
        own = F.filter("steps", lambda s: s["bit"] == bit)
        return F.aggregate(own, F.lit(0).cast("bigint"), lambda total, s: total + s["removed"])

    parts = parts.withColumn("shapley", F.array(*(removed(i) for i in range(len(names)))))
    rows = parts.select("part", "shapley", F.posexplode("steps").alias("at", "s"))
    spelled = F.array(*(F.lit("".join(names[i] for i in order)) for order in every))
    return rows.select(
        "part",
        F.get(spelled, F.expr(f"cast(at div {len(names)} as int)")).alias("filter_order"),
        (F.col("at") % len(names) + 1).cast("int").alias("step"),
        *(F.col(f"s.{c}").alias(c) for c in _COUNTS),
        F.get(F.col("shapley"), F.col("s.bit")).alias("shapley"),
    )


def interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over all documents."""
    return audit(count_cells(measure(docs), labels))
