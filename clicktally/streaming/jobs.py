"""The streaming jobs: counts into a table, rejects into files, enrichment into a topic."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from clicktally.config import if_exists
from clicktally.operators.ads import drop_blacklisted, province_top_ads
from clicktally.operators.clicks import (
    countable,
    parse_clicks,
    rejects,
    running_clicks,
    visitor_sketches,
)
from clicktally.operators.enrich import (
    Rule,
    apply_rules,
    parse_vehicles,
    to_json_value,
    vehicle_rejects,
)
from clicktally.operators.stored import changed_only
from clicktally.schemas import APP_RESTART
from clicktally.sources.feed import publish
from clicktally.sources.rules import read_rules
from clicktally.sources.tables import (
    ResultTable,
    add_visitors,
    bind,
    change_log,
    read_table,
    replace_groups,
    upsert_accumulate,
    upsert_overwrite,
)


def _stored_near(batch: DataFrame, table: ResultTable, before: tuple[int, int]) -> DataFrame:
    """The stored rows that a (cached) batch may meet: its range of dates and its keys only."""
    stored = read_table(batch.sparkSession, table, before)
    first, last = batch.agg(F.min("date"), F.max("date")).first()
    stored = stored.filter(F.col("date").between(first, last))
    # With a small batch Spark broadcasts its keys and filters before the table is merged.
    return stored.join(batch.select(*table.spec.keys), list(table.spec.keys), "left_semi")


def write_counts(
    batch: DataFrame, batch_id: int, table: ResultTable, skip_unchanged: bool = True
) -> None:
    """Upsert one micro-batch of counts, at will without those the table already holds.

    The comparison leaves out this very batch, so a repeated delivery finds and writes the same.
    """
    if not skip_unchanged:
        upsert_overwrite(batch, table, batch_id, unique=True)
        return
    cached = batch.persist()
    try:
        stored = _stored_near(cached, table, before=(0, batch_id))
        changed = changed_only(cached, stored, table.spec.keys)
        upsert_overwrite(changed, table, batch_id, unique=True)
    finally:
        cached.unpersist()


def _started(writer: DataStreamWriter, checkpoint: str, trigger: Mapping[str, object] | None) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_click_counts(
    feed: DataFrame,
    table: ResultTable,
    checkpoint: str,
    position: str | None = APP_RESTART,
    mode: str | None = None,
    rejects_path: str | None = None,
    skip_unchanged: bool | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep ``index_gid_click_count`` up to date from a feed of click records.

    ``mode="delta"``, the one for a table kept by sums, counts the records of each batch and adds them
    to the table under the batch's number, so a batch that comes again adds nothing. There is no state
    and no watermark: a record counts under its own date, however late or early it is. The same
    parse of a batch gives its rejects, below ``rejects_path`` if that is named.

    The other modes keep every key in the stream's state, for a table of newest counts: ``"update"``
    hands on the keys a batch touched, ``"complete"`` all keys each time, which also repairs rows that
    were changed in the table. ``skip_unchanged`` leaves out counts the table already holds. It is on
    for ``complete`` and off for ``update``, where each count that comes is a new one and a write
    needs to read nothing.

    Counts go on from the checkpoint, which is tied to the table: see ``tables.bind``.
    """
    sums = table.spec.merge == "sum"
    mode = mode or ("delta" if sums else "update")
    if (mode == "delta") != sums:
        raise ValueError(f"mode {mode!r} does not go with a table kept by {table.spec.merge!r}")
    if mode != "delta" and rejects_path is not None:
        raise ValueError("with state, rejects are a stream of their own: use start_rejects")
    bind(feed.sparkSession, table, checkpoint)
    if mode == "delta":

        def add(batch: DataFrame, batch_id: int) -> None:
            parsed = parse_clicks(batch.withColumn("text", F.col("value"))).persist()
            try:
                upsert_accumulate(running_clicks(countable(parsed, position)), table, batch_id)
                if rejects_path is not None:
                    bad = rejects(parsed, position).select("key", F.col("text").alias("value"), "reason")
                    bad.write.mode("overwrite").parquet(f"{rejects_path}/batch={batch_id}")
            finally:
                parsed.unpersist()

        return _started(feed.writeStream.foreachBatch(add), checkpoint, trigger)
    if skip_unchanged is None:
        skip_unchanged = mode == "complete"
    counts = running_clicks(countable(parse_clicks(feed), position))

    def write(batch: DataFrame, batch_id: int) -> None:
        write_counts(batch, batch_id, table, skip_unchanged)

    return _started(counts.writeStream.outputMode(mode).foreachBatch(write), checkpoint, trigger)


def state_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The counts in the state of a stopped stream that keeps every key (modes ``update``, ``complete``).

    It is what the stream goes on from, so it tells whether a table has all of it.
    """
    state = spark.read.format("statestore").load(checkpoint)
    keys = ("date", "position", "userid")
    return state.select(*(F.col(f"key.{c}").alias(c) for c in keys), F.col("value.count").alias("clickCount"))


def start_table(
    rows: DataFrame,
    counts: Callable[[DataFrame], DataFrame],
    table: ResultTable,
    checkpoint: str,
    blacklist: ResultTable | None = None,
    top: ResultTable | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Add the ``counts`` of each batch of streaming ``rows`` to a table kept by sums.

    With a ``blacklist`` its users are left out, as the list is when the batch runs. With ``top``, for
    counts per region, the top ads of the dates and provinces that the batch touched are taken anew from
    their stored counts, and replace the groups there.
    """
    if table.spec.merge != "sum":
        raise ValueError(f"a stream adds to a table kept by 'sum', not by {table.spec.merge!r}")
    bind(rows.sparkSession, table, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if blacklist is not None:
            batch = drop_blacklisted(batch, read_table(spark, blacklist))
        upsert_accumulate(counts(batch), table, batch_id)
        if top is not None:
            added = change_log(spark, table).filter((F.col("run") == 0) & (F.col("batch") == batch_id))
            first, last = added.agg(F.min("date"), F.max("date")).first()
            stored = read_table(spark, table, before=(0, batch_id + 1)).filter(F.col("date").between(first, last))
            # Spark pushes the join below the merge: of the stored rows only those of touched groups are merged
            groups = added.select("date", "province").distinct()
            replace_groups(province_top_ads(stored.join(groups, ["date", "province"], "left_semi")), top, batch_id)

    return _started(rows.writeStream.foreachBatch(add), checkpoint, trigger)


def start_rejects(
    feed: DataFrame,
    path: str,
    checkpoint: str,
    position: str | None = APP_RESTART,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep the records that cannot be judged, with their text and the reason, as parquet."""
    kept = feed.withColumn("text", F.col("value"))
    bad = rejects(parse_clicks(kept), position).select("key", F.col("text").alias("value"), "reason")
    writer = (
        bad.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_console(
    df: DataFrame, mode: str = "update", trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Print a stream's rows, for looking at it by hand."""
    writer = df.writeStream.outputMode(mode).format("console").option("truncate", "false")
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def enriched(feed: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Feed records with rules applied to their fields, back as ``key, value``."""
    return to_json_value(apply_rules(parse_vehicles(feed), rules), "key")


def start_enrichment(
    feed: DataFrame,
    rules: Iterable[Rule],
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Parse, enrich and publish the good records of a feed; the key is not sent on.

    Bad records are kept by :func:`start_enrichment_rejects`; start both.
    """
    return publish(
        enriched(feed, rules), fmt, options, path, checkpoint, with_key=False, trigger=trigger
    )


def start_stored_enrichment(
    feed: DataFrame,
    rules_path: str,
    checkpoint: str,
    fmt: str = "kafka",
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """The enrichment with rules that are stored outside and may change while the stream runs.

    Each batch takes the newest version, so a change holds from the next batch on, and every record
    says in ``rules_version`` by which it was made. A batch that comes again takes the version that it
    had, which is noted before it is published. File sinks get a folder per batch, which a repeated
    batch replaces; a topic gets its records again.
    """

    def enrich(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        noted = f"{checkpoint}/rules/batch={batch_id}"
        had = if_exists(lambda: spark.read.schema("version bigint").parquet(noted))
        row = had.first() if had is not None else None
        version, rules = read_rules(spark, rules_path, row.version if row is not None else None)
        if row is None:
            spark.range(1).select(F.lit(version).cast("bigint").alias("version")).write.mode("overwrite").parquet(noted)
        made = apply_rules(parse_vehicles(batch), rules).withColumn("rules_version", F.lit(version))
        records = to_json_value(made, "key").select("value")
        writer = records.write.format(fmt).options(**(options or {}))
        if path:
            writer.mode("overwrite").save(f"{path}/batch={batch_id}")
        else:
            writer.mode("append").save()

    return _started(feed.writeStream.foreachBatch(enrich), checkpoint, trigger)


def start_visitors(
    rows: DataFrame,
    visitors: ResultTable,
    checkpoint: str,
    exact: ResultTable | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep page views and a sketch of the visitors per date and position of streaming clicks.

    The sketches of any dates unite, so visitors of any span are read from a row per date. With
    ``exact``, a table of clicks per user kept by sums, the exact numbers are kept beside them.
    """
    bind(rows.sparkSession, visitors, checkpoint)

    def add(batch: DataFrame, batch_id: int) -> None:
        counts = running_clicks(batch).persist()
        try:
            if exact is not None:
                upsert_accumulate(counts, exact, batch_id)
            add_visitors(visitor_sketches(counts), visitors, batch_id)
        finally:
            counts.unpersist()

    return _started(rows.writeStream.foreachBatch(add), checkpoint, trigger)


def start_enrichment_rejects(
    feed: DataFrame, path: str, checkpoint: str, trigger: Mapping[str, object] | None = None
) -> StreamingQuery:
    """Keep the records that are not enriched, with their text and the reason, as parquet."""
    writer = vehicle_rejects(feed).writeStream.format("parquet").option("path", path)
    return _started(writer, checkpoint, trigger)
