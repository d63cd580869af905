"""Where click records come from and where records are published to.

A feed is a DataFrame ``key STRING, value STRING``, streaming or batch. The format is a Spark
source name: ``kafka`` in production, a file format with the same two columns elsewhere.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clicktally.schemas import FEED


def kafka_options(
    servers: str, topic: str, start: str = "latest", saved: Mapping[int, int] | None = None
) -> dict[str, str]:
    """Options for one topic.

    ``start`` is ``earliest`` or ``latest``. ``saved`` gives a position for every partition instead,
    for a first start; a position that the topic no longer holds moves on to the earliest one it
    does. Later starts go by the checkpoint.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if saved:
        positions = {str(partition): offset for partition, offset in sorted(saved.items())}
        options["startingOffsets"] = json.dumps({topic: positions})
        options["failOnDataLoss"] = "false"
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_clicks(
    spark: SparkSession,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    key_from: str = "key",
    streaming: bool = True,
) -> DataFrame:
    """The feed as ``key, value`` text. ``key_from="topic"`` gives the topic name as the key."""
    reader = (spark.readStream if streaming else spark.read).format(fmt).options(**(options or {}))
    if fmt != "kafka":
        reader = reader.schema(FEED)
    source = reader.load(path) if path else reader.load()
    return source.select(
        F.col(key_from).cast("string").alias("key"), F.col("value").cast("string").alias("value")
    )


def batch_ranges(query: StreamingQuery) -> list[dict]:
    """Start and end position per source of the last batch a query ran."""
    progress = query.lastProgress
    if progress is None:
        return []
    return [
        {"source": s["description"], "start": s["startOffset"], "end": s["endOffset"]}
        for s in progress["sources"]
    ]


def publish(
    df: DataFrame,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    checkpoint: str | None = None,
    with_key: bool = True,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery | None:
    """Send ``value`` (and ``key``, unless told not to) to a topic or a file sink.

    A batch DataFrame is written at once; a streaming one needs ``checkpoint`` and gives its query.
    """
    records = df.select(*(["key"] if with_key else []), "value")
    options = dict(options or {})
    if path:
        options["path"] = path
    if not records.isStreaming:
        records.write.format(fmt).options(**options).mode("append").save()
        return None
    if checkpoint is None:
        raise ValueError("a streaming publish needs a checkpoint folder")
    writer = records.writeStream.format(fmt).options(**options).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
