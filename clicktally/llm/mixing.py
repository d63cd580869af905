"""Sources interleaved to target weights by Pfair scheduling.

A source with ``a`` of the ``A`` parts of a cycle gets its i-th block released at slot ``i A / a``
(rounded down), with a deadline of ``(i + 1) A / a`` (rounded up). In each slot the released block
with the earliest deadline goes first. As the parts add up to the cycle, every block meets its
deadline: at any time each source that still has blocks is less than one block from its target.

The windows repeat with the cycle, so one cycle is scheduled, from one row per source, and all blocks
are placed by a join with it. Documents get their place in their source from a hash of the id, by
counts per range of hashes and a rank inside a range, so that no source has to be in one task.

Everything is made of built-in functions. Defined results: a null source is the empty one; a source
without a given weight is not wanted and its documents have no slot; repeated ids are placed one
after the other; a source that has ended leaves its slots free, nothing is repeated or dropped; rows
without id come first in their source. Texts are not read, unless they are to be carried along.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Documents in a block.
BLOCK = 32
#: About the number of slots in a cycle, if the weights are not whole numbers.
CYCLE = 1000
#: Documents of a source whose ranks one task counts, about.
RANGE_ROWS = 2_000


def tempered_parts(docs: DataFrame, cycle: int = CYCLE) -> dict[str, int]:
    """Parts of a cycle in proportion to the square root of a source's number of documents.

    Large sources are held back and small ones lifted; each gets one part at least.
    """
    counts = docs.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sqrt(F.count("*")).alias("w"))
    rows = counts.orderBy("source").collect()  # a row per source
    total = math.fsum(r.w for r in rows)
    return {r.source: max(1, math.floor(cycle * r.w / total + 0.5)) for r in rows}


def one_cycle(parts: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """Source, block of the cycle and slot, by earliest deadline among the released blocks.

    Equal deadlines go by the name of the source.
    """
    length = sum(parts.values())
    waiting = [(0, name, 0) for name in sorted(parts)]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # by deadline
    slots = []
    for slot in range(length):
        while waiting and waiting[0][0] <= slot:
            _, name, block = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(block + 1) * length // parts[name]), name, block))
        _, name, block = heapq.heappop(ready)
        slots.append((name, block, slot))
        if block + 1 < parts[name]:
            heapq.heappush(waiting, ((block + 1) * length // parts[name], name, block + 1))
    return slots


def _ranked(docs: DataFrame, range_rows: int, row: list[str]) -> DataFrame:
    """Documents with their rank in their source, from 0, in the order of a hash of the id.

    Columns ``row`` are carried along, and order rows of one id: a task that runs again gives the same.
    """
    keyed = docs.select(
        "doc_id",
        "source",
        *row,
        *(F.xxhash64(F.to_json(c)).alias("tie") for c in row),
        F.coalesce("source", F.lit("")).alias("name"),
        F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("mixed"),
    )
    n = F.greatest(F.lit(1), F.ceil(F.count("*") / range_rows))
    ranges = keyed.agg(n.alias("n")).first().n
    place = F.coalesce(F.conv(F.substring("mixed", 1, 8), 16, 10).cast("bigint"), F.lit(0))
    keyed = keyed.withColumn("range", F.shiftright(place * F.lit(ranges), 32))
    sizes = keyed.drop(*row).groupBy("name", "range").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.partitionBy("name").orderBy("range")) - F.col("size")
    offsets = sizes.select("name", "range", before.alias("offset"))
    inside = F.row_number().over(Window.partitionBy("name", "range").orderBy("mixed", "doc_id", *("tie" for _ in row)))
    ranked = keyed.withColumn("inside", inside).join(offsets, ["name", "range"])
    return ranked.select("doc_id", "source", *row, "name", (F.col("offset") + F.col("inside") - 1).alias("rank"))


def mix(
    docs: DataFrame,
    parts: Mapping[str, int] | None = None,
    block: int = BLOCK,
    range_rows: int = RANGE_ROWS,
    carry: bool = False,
) -> DataFrame:
    """Every document's place in the mixture: sorted by ``slot`` and ``place`` it is the order to train in.

    ``parts`` are whole numbers by source; without them ``tempered_parts`` are taken. The columns are
    ``doc_id``, ``source``, ``block`` (of the source), ``place`` (in the block), ``release``,
    ``deadline`` and ``slot``. With ``carry`` the documents' other columns follow, as they are; one that
    has the name of a column of the mixture follows as ``given_`` and that name.
    """
    parts = dict(parts) if parts is not None else tempered_parts(docs)
    others = [c for c in docs.columns if c.lower() not in ("doc_id", "source")] if carry else []
    row = ["row"] if others else []
    docs = docs.select(
        F.col("doc_id").cast("bigint"), "source", *(F.struct(*(F.col(f"`{c}`") for c in others)).alias(r) for r in row)
    )
    length = sum(parts.values())
    cycle = json.dumps([{"name": name, "step": b, "at": slot, "parts": parts[name]} for name, b, slot in one_cycle(parts)])
    schedule = docs.sparkSession.range(1).select(
        F.inline(F.from_json(F.lit(cycle), "array<struct<name:string,step:bigint,at:bigint,parts:bigint>>"))
    )
    shares = schedule.where("step = 0").select("name", "parts")
    blocks = (
        _ranked(docs, range_rows, row)
        .select("doc_id", "source", *row, "name", F.expr(f"rank div {block}").alias("block"), F.expr(f"rank % {block}").alias("place"))
        .join(shares, "name", "left")
        .withColumn("step", F.col("block") % F.col("parts"))
    )
    placed = blocks.join(schedule.drop("parts"), ["name", "step"], "left")
    taken = {"block", "place", "release", "deadline", "slot"}
    follow = [F.col(f"row.`{c}`").alias(f"given_{c}" if c.lower() in taken else c) for c in others]
    return placed.select(
        "doc_id",
        "source",
        "block",
        "place",
        F.expr(f"block * {length} div parts").alias("release"),
        F.expr(f"((block + 1) * {length} + parts - 1) div parts").alias("deadline"),
        F.expr(f"(block div parts) * {length} + at").alias("slot"),
        *follow,
    )
