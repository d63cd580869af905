"""Which positions of a feed each batch took, kept beside a stream, with a check for gaps and overlaps.

The checkpoint decides where a stream goes on; the ledger is for people: it outlives the checkpoint, so
runs with different checkpoints can be compared. A row is a batch and a part of a source: a partition
of a topic, or a file source as a whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktally.config import if_exists

LEDGER = (
    "query string, run string, batch bigint, at timestamp, source string, part string, start bigint, `end` bigint, `rows` bigint"
)
_COLUMNS = [part.split()[0].strip("`") for part in LEDGER.split(", ")]


def _flat(offset: object, name: str = "") -> Iterator[tuple[str, int]]:
    """The numbers of a position with the names that lead to them; a source without one starts at nothing."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return
    if isinstance(offset, dict):
        for key, value in offset.items():
            yield from _flat(value, f"{name}/{key}" if name else str(key))
    elif isinstance(offset, (int, float)):
        yield name, int(offset)


def record(spark: SparkSession, path: str, query: StreamingQuery) -> int:
    """Keep the ranges of the batches that a query has ended, and return of how many.

    Call it every now and then while the query runs, and after it: Spark remembers the last
    ``spark.sql.streaming.numRecentProgressUpdates`` batches. A batch that is recorded twice, also by
    a run that had to do it again, is kept once per run.
    """
    rows: dict[int, list[tuple]] = {}
    for progress in (json.loads(p.json) for p in query.recentProgress):
        for source in progress["sources"]:
            ends, starts = dict(_flat(source["endOffset"])), dict(_flat(source["startOffset"]))
            for part, end in ends.items():
                row = (query.id, query.runId, progress["batchId"], progress["timestamp"], source["description"], part, starts.get(part), end)
                if starts.get(part) != end:  # a progress without new data repeats the last position
                    rows.setdefault(progress["batchId"], []).append((*row, source["numInputRows"]))
    if rows:
        kind = LEDGER.replace("at timestamp", "at string")
        flat = spark.createDataFrame([r for batch in rows.values() for r in batch], kind)
        flat = flat.withColumn("at", F.col("at").cast("timestamp"))
        # the folder of this run is written anew, with what it held and is forgotten by now
        own = f"{path}/query={query.id}/run={query.runId}"
        before = if_exists(lambda: spark.read.schema(flat.drop("query", "run").schema).parquet(own))
        if before is not None:
            kept = before.filter(~F.col("batch").isin(list(rows))).collect()  # a row per batch and part
            flat = flat.drop("query", "run").unionByName(spark.createDataFrame(kept, before.schema))
        flat.drop("query", "run").coalesce(1).write.mode("overwrite").parquet(own)
    return len(rows)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    found = if_exists(lambda: spark.read.schema(LEDGER).parquet(path))
    return spark.createDataFrame([], LEDGER) if found is None else found.select(*_COLUMNS)


def faults(ledger: DataFrame) -> DataFrame:
    """Where a part of a source does not go on where it ended: a ``gap`` or an ``overlap``, and how long.

    Batches count in the order of their time; a range that a run has done again from the same start is
    no fault, as the table replaces the batch.
    """
    names = ("source", "part")
    last = Window.partitionBy(*names, "query", "batch").orderBy(F.desc("at"), F.desc("run"))
    once = ledger.withColumn("_place", F.row_number().over(last)).filter("_place = 1")
    along = Window.partitionBy(*names).orderBy("at", "batch").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max("end").over(along)
    apart = F.col("start") - F.col("reached")
    return (
        once.withColumn("reached", reached)
        .withColumn("fault", F.when(apart > 0, "gap").when(apart < 0, "overlap"))
        .filter("fault IS NOT NULL OR (reached IS NOT NULL AND start IS NULL)")
        .select(*_COLUMNS[:4], *names, "reached", "start", F.coalesce("fault", F.lit("overlap")).alias("fault"), F.abs(F.coalesce(apart, F.col("reached"))).alias("length"))
    )
