from __future__ import annotations

import json
import re
import shutil
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clicktally.config import CLUSTER_CONF, new_run_dir, shared_dir
from clicktally.operators.clicks import countable, hourly_pv, parse_clicks, running_clicks
from clicktally.operators.enrich import Rule, parse_vehicles
from clicktally.operators import ads
from clicktally.schemas import AD_BLACKLIST, AD_USER_CLICK_COUNT, INDEX_CLICK_COUNT, INDEX_CLICK_COUNT_SUM
from clicktally.sources import feed as feeds
from clicktally.sources import tables
from clicktally.sources.tables import ResultTable
from clicktally.streaming import jobs, main
from tests.conftest import rows

ONCE = {"availableNow": True}
DAY = 86400
D1 = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())


class Job:
    """A feed folder, a table and a checkpoint, with runs that take in what has arrived."""

    def __init__(self, spark, label="job", mode="update"):
        self.spark = spark
        self.folder = new_run_dir(spark, label)
        spec = INDEX_CLICK_COUNT_SUM if mode == "delta" else INDEX_CLICK_COUNT
        self.table = ResultTable(spec, f"{self.folder}/table")
        self.checkpoint = f"{self.folder}/checkpoint"

    def arrive(self, *clicks):
        """Clicks as (epoch seconds, position, user)."""
        data = [
            ("k", json.dumps({"user_id": u, "timestamp": t, "content": {"click_position": p}}))
            for t, p, u in clicks
        ]
        frame = self.spark.createDataFrame(data, "key STRING, value STRING")
        frame.coalesce(1).write.mode("append").parquet(f"{self.folder}/feed")

    def feed(self, **options):
        return feeds.read_clicks(self.spark, "parquet", options, path=f"{self.folder}/feed")

    def run(self, position="a", files_per_batch=None, **options):
        source = {"maxFilesPerTrigger": str(files_per_batch)} if files_per_batch else {}
        query = jobs.start_click_counts(
            self.feed(**source), self.table, self.checkpoint, position, trigger=ONCE, **options
        )
        query.awaitTermination()
        return query

    def stored(self):
        return rows(tables.read_table(self.spark, self.table))

    def batch_result(self, position="a"):
        feed = feeds.read_clicks(self.spark, "parquet", path=f"{self.folder}/feed", streaming=False)
        return rows(running_clicks(countable(parse_clicks(feed), position)))


@pytest.fixture
def job(spark):
    return Job(spark)


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


@pytest.fixture
def adding(spark):
    return Job(spark, mode="delta")


@pytest.mark.parametrize("mode", ["update", "complete", "delta"])
def test_stream_equals_batch_over_several_batches_and_restarts(spark, mode):
    job = Job(spark, mode=mode)
    job.arrive((D1, "a", 1), (D1, "a", 2), (D1, "b", 1))
    job.arrive((D1 + 9, "a", 1), (D1 + DAY, "a", 1))
    job.run(files_per_batch=1, mode=mode)
    assert job.stored() == job.batch_result()
    job.arrive((D1 + 20, "a", 1), (D1 + DAY, "a", ""), (D1 + DAY, "a", None))
    job.run(mode=mode)
    assert job.stored() == job.batch_result()
    assert ("2024-01-01", "a", "1", 3) in job.stored()
    assert ("2024-01-02", "a", "-99", 2) in job.stored()


@pytest.mark.parametrize("mode", ["update", "complete"])
def test_a_batch_writes_one_file_a_date(spark, job, mode):
    """Not one per shuffle partition, though a stream with state runs without adaptive execution."""
    job.arrive(*((D1 + day * DAY, "a", user) for day in (0, 1) for user in range(40)))
    job.run(mode=mode)
    files = spark.read.parquet(job.table.path).inputFiles()
    assert len(files) == 2


def test_nothing_new_changes_nothing(job):
    job.arrive((D1, "a", 1))
    job.run()
    job.run()
    assert job.stored() == [("2024-01-01", "a", "1", 1)]


def test_complete_mode_writes_changed_keys_only_and_repairs(spark, job):
    job.arrive((D1, "a", 1), (D1, "a", 2))
    job.run(mode="complete")
    job.arrive((D1, "a", 2))
    job.run(mode="complete")
    assert tables.batch_rows(spark, job.table, 1) == 1
    # A row changed in the table comes right with the next batch, though its key is not in it.
    wrong = spark.createDataFrame([("2024-01-01", "a", "1", 99)], INDEX_CLICK_COUNT.schema)
    tables.upsert_overwrite(wrong, job.table, 1)
    job.arrive((D1, "a", 2))
    job.run(mode="complete")
    assert job.stored() == [("2024-01-01", "a", "1", 1), ("2024-01-01", "a", "2", 3)]


@pytest.mark.parametrize("skip_unchanged", [True, False])
def test_repeated_delivery_of_a_batch(spark, job, skip_unchanged):
    first = spark.createDataFrame([("2024-01-01", "a", "1", 1)], INDEX_CLICK_COUNT.schema)
    second = spark.createDataFrame(
        [("2024-01-01", "a", "1", 2), ("2024-01-01", "a", "2", 1)], INDEX_CLICK_COUNT.schema
    )
    jobs.write_counts(first, 0, job.table, skip_unchanged=skip_unchanged)
    for _ in range(2):
        jobs.write_counts(second, 1, job.table, skip_unchanged=skip_unchanged)
        assert job.stored() == rows(second)


@pytest.mark.parametrize("dates", [1, 1000])
def test_unchanged_rows_are_compared_within_the_dates_of_the_batch(spark, job, dates):
    counts = spark.range(dates).selectExpr(
        "CAST(DATE'2024-01-01' + CAST(id AS INT) AS STRING) AS date", "'a' AS position", "'1' AS userid", "id AS clickCount"
    )
    other = spark.createDataFrame([("2023-01-01", "a", "1", 5)], INDEX_CLICK_COUNT.schema)
    tables.upsert_overwrite(counts.unionByName(other).coalesce(1), job.table, 0)
    near = jobs._stored_near(counts.cache(), job.table, (0, 1))
    length = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = near._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.maxMetadataStringLength", length)
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any(re.search(r"date#\d+ >= 2024-01-01", f) and re.search(r"date#\d+ <= ", f) for f in filters), filters
    assert near.count() == dates
    changed = counts.withColumn("clickCount", F.expr("IF(date = '2024-01-01', 99L, clickCount)"))
    jobs.write_counts(changed, 1, job.table)
    assert tables.batch_rows(spark, job.table, 1) == 1


def test_late_and_far_clicks_are_all_counted(adding):
    """One bad clock does not end the counting, and no day is ever closed."""
    job = adding
    job.arrive((D1, "a", 1), (9999999999, "a", 1), (D1 * 1000, "a", 1))
    job.run()
    job.arrive(*((D1 + i, "a", 1) for i in range(10)))
    job.run()
    job.arrive((D1 + 400 * DAY, "a", 1), *((D1 + i, "a", 1) for i in range(5)))
    query = job.run()
    assert query.lastProgress["stateOperators"] == []
    assert job.stored() == job.batch_result()
    assert ("2024-01-01", "a", "1", 16) in job.stored() and len(job.stored()) == 4


def test_a_batch_that_comes_again_adds_nothing(spark, adding, monkeypatch):
    """The sink fails after it has written; the batch is delivered again."""
    job = adding
    job.arrive((D1, "a", 1), ("soon", "a", 2))
    real = jobs.upsert_accumulate

    def broken(*args):
        real(*args)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "upsert_accumulate", broken)
        with pytest.raises(StreamingQueryException, match="lost"):
            job.run(rejects_path=f"{job.folder}/rejects")
    job.run(rejects_path=f"{job.folder}/rejects")
    assert job.stored() == [("2024-01-01", "a", "1", 1)]
    assert spark.read.parquet(f"{job.folder}/rejects").count() == 1


@pytest.mark.parametrize("name", ["Asia/Shanghai", "America/New_York"])
def test_days_are_those_of_the_zone(spark, zone, name):
    """Around the New York night of 2024-03-10, a day of 23 hours."""
    local = ZoneInfo(name)
    hours = [(9, 23), (10, 0), (10, 1), (10, 3), (10, 22), (10, 23), (11, 0), (11, 1)]
    times = [int(datetime(2024, 3, d, h, 30, tzinfo=local).timestamp()) for d, h in hours]
    with zone(name):
        job = Job(spark, "zone", mode="delta")
        for half in (times[:5], times[5:]):
            job.arrive(*((t, "a", 1) for t in half))
            job.run()
        assert job.stored() == [
            ("2024-03-09", "a", "1", 1),
            ("2024-03-10", "a", "1", 5),
            ("2024-03-11", "a", "1", 2),
        ]


def test_new_checkpoint_over_a_filled_table_is_refused(job):
    job.arrive((D1, "a", 1))
    job.run()
    job.checkpoint += "-new"
    with pytest.raises(ValueError, match="holds rows but"):
        job.run()
    job.table = ResultTable(INDEX_CLICK_COUNT, f"{job.folder}/table2")
    job.run()
    assert job.stored() == [("2024-01-01", "a", "1", 1)]


def test_old_checkpoint_with_another_table_is_refused(spark, job):
    job.arrive((D1, "a", 1), (D1, "a", 2))
    job.run()
    full = job.table
    job.table = ResultTable(INDEX_CLICK_COUNT, f"{job.folder}/table2")
    with pytest.raises(ValueError, match="another table"):
        job.run()
    other = Job(spark)
    other.arrive((D1, "a", 3))
    other.run()
    job.table = other.table
    with pytest.raises(ValueError, match="another table"):
        job.run()
    job.table = full
    job.arrive((D1, "a", 1))
    job.run()
    assert job.stored() == job.batch_result()


def test_a_table_that_was_emptied_is_refused(spark, job, tmp_path):
    job.table = ResultTable(INDEX_CLICK_COUNT, str(tmp_path / "table"))
    job.arrive((D1, "a", 1))
    job.run()
    shutil.rmtree(tmp_path / "table")
    with pytest.raises(ValueError, match="another table"):
        job.run()


def test_modes_go_with_the_kind_of_table(job, adding):
    with pytest.raises(ValueError, match="kept by"):
        jobs.start_click_counts(None, job.table, job.checkpoint, mode="delta")
    with pytest.raises(ValueError, match="kept by"):
        jobs.start_click_counts(None, adding.table, job.checkpoint, mode="complete")
    with pytest.raises(ValueError, match="start_rejects"):
        jobs.start_click_counts(None, job.table, job.checkpoint, mode="update", rejects_path="x")


def test_a_failing_sink_fails_the_query_and_loses_nothing(job, monkeypatch):
    job.arrive((D1, "a", 1))

    def broken(*_args, **_kwargs):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "upsert_overwrite", broken)
        with pytest.raises(StreamingQueryException, match="no space"):
            job.run()
    job.run()
    assert job.stored() == [("2024-01-01", "a", "1", 1)]


def test_a_compacted_table_goes_on(spark, job):
    job.arrive((D1, "a", 1))
    job.run()
    job.arrive((D1, "a", 1), (D1, "a", 2))
    job.run()
    job.table = tables.compact(spark, job.table, f"{job.folder}/compacted")
    job.arrive((D1, "a", 2))
    job.run()
    assert job.stored() == job.batch_result()


def test_rejects_stream(spark, job):
    data = [("1", "{"), ("2", '{"user_id": 1}'), ("3", '{"timestamp":"x","content":{"click_position":"a"}}')]
    good = ("4", json.dumps({"timestamp": D1, "content": {"click_position": "a"}}))
    frame = spark.createDataFrame([*data, good], "key STRING, value STRING")
    frame.write.parquet(f"{job.folder}/feed")
    out = f"{job.folder}/rejects"
    jobs.start_rejects(job.feed(), out, job.checkpoint, "a", ONCE).awaitTermination()
    got = spark.read.parquet(out).select("key", "value", "reason")
    assert rows(got) == [(*d, r) for d, r in zip(data, ("malformed", "no_content", "bad_timestamp"))]


def test_hourly_pv_runs_on(spark, job):
    """One running count per hour over two batches."""
    job.arrive((D1, "a", 1), (D1 + 3599, "b", 1))
    job.arrive((D1 + 60, "a", 2), (D1 + 3600, "a", 1))
    views = hourly_pv(countable(parse_clicks(job.feed(maxFilesPerTrigger="1")), None))
    writer = views.writeStream.outputMode("complete").format("memory").queryName("hourly")
    writer.option("checkpointLocation", job.checkpoint).trigger(**ONCE).start().awaitTermination()
    assert rows(spark.table("hourly")) == [("2024-01-01 00", 3), ("2024-01-01 01", 1)]


def test_console(job):
    job.arrive((D1, "a", 1))
    query = jobs.start_console(countable(parse_clicks(job.feed()), "a"), trigger=ONCE)
    query.awaitTermination()
    assert query.exception() is None


def test_cluster_settings(spark, job):
    session = spark.newSession()
    for name, value in {**CLUSTER_CONF, "spark.sql.shuffle.partitions": "2"}.items():
        session.conf.set(name, value)
    job.spark = session
    job.arrive((D1, "a", 1))
    job.run()
    job.arrive((D1, "a", 1), (D1, "a", 2))
    query = job.run()
    assert "rocksdbCommitCheckpointLatency" in query.lastProgress["stateOperators"][0]["customMetrics"]
    assert job.stored() == job.batch_result()


def argv(job, *more):
    words = f"--format parquet --path {job.folder}/feed --position a --once --zone UTC"
    return [*f"{words} --table {job.table.path} --checkpoint {job.checkpoint}".split(), *more]


@pytest.mark.parametrize("mode", ["delta", "update"])
def test_program(spark, mode):
    job = Job(spark, mode=mode)
    job.arrive((D1, "a", 1), (D1, "a", 1), ("soon", "a", 2))
    job.arrive((D1, "a", 1))
    queries = main.start(spark, main.arguments(argv(job, "--mode", mode, "--option", "maxFilesPerTrigger=1")))
    for query in queries:
        query.awaitTermination()
    assert max(p["batchId"] for p in queries[0].recentProgress) == 1
    assert job.stored() == [("2024-01-01", "a", "1", 3)]
    assert [r.reason for r in spark.read.parquet(f"{job.table.path}_rejects").collect()] == ["bad_timestamp"]


def test_program_arguments(spark, job):
    kafka = "--servers s:1 --topic t --table x --zone UTC --checkpoint"
    args = main.arguments([*kafka.split(), "y"])
    assert (args.position, args.mode, args.every, args.rejects) == ("app_restart", "delta", "5 seconds", "x_rejects")
    for wrong in ("--table x --checkpoint y --zone UTC", "--format json --table x --checkpoint y --zone UTC", "--servers s:1", "--servers s:1 --topic t --table x --checkpoint y"):
        with pytest.raises(SystemExit):
            main.arguments(wrong.split())
    more = "--group g --saved 0:10,1:20 --option kafka.security.protocol=SSL --option maxOffsetsPerTrigger=5"
    args = main.arguments([*kafka.split(), job.checkpoint, *more.split()])
    first = main.source_options(spark, args)
    assert first["kafka.group.id"] == "g" and first["kafka.security.protocol"] == "SSL" and first["maxOffsetsPerTrigger"] == "5"
    assert json.loads(first["startingOffsets"]) == {"t": {"0": 10, "1": 20}} and first["failOnDataLoss"] == "false"
    spark.range(1).selectExpr("'{}' AS value").write.text(f"{job.checkpoint}/counts/metadata")
    later = main.source_options(spark, args)
    assert "failOnDataLoss" not in later and later["startingOffsets"] == "latest"


def test_a_user_listed_after_the_start_is_left_out_of_the_next_batch(spark, job):
    blacklist = ResultTable(AD_BLACKLIST, f"{job.folder}/blacklist")
    table = ResultTable(AD_USER_CLICK_COUNT, f"{job.folder}/ads")
    schema = "date STRING, userid BIGINT, adid BIGINT"
    for batch, users in enumerate(([1, 2], [1, 2])):
        spark.createDataFrame([("2024-01-01", u, 7) for u in users], schema).coalesce(1).write.mode("append").parquet(f"{job.folder}/in")
    tables.append(spark.createDataFrame([(2,)], "userid BIGINT"), blacklist, 0)
    feed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{job.folder}/in")
    seen = []

    def counts(batch):
        seen.append(1)
        if len(seen) == 1:
            tables.append(spark.createDataFrame([(1,)], "userid BIGINT"), blacklist, 1)
        return ads.user_ad_counts(batch)

    query = jobs.start_table(feed.select("date", "userid", "adid"), counts, table, job.checkpoint, blacklist=blacklist, trigger=ONCE)
    query.awaitTermination()
    found = rows(tables.read_table(spark, table))
    assert len(seen) >= 2 and {r[1] for r in found} == {1} and found[0][3] < 2


def test_batch_ranges(job):
    job.arrive((D1, "a", 1))
    query = job.run()
    ranges = feeds.batch_ranges(query)
    assert len(ranges) == 1 and ranges[0]["end"] is not None


def test_kafka_options():
    plain = feeds.kafka_options("host:1", "clicks", start="earliest")
    assert plain == {"kafka.bootstrap.servers": "host:1", "subscribe": "clicks", "startingOffsets": "earliest"}
    saved = feeds.kafka_options("host:1", "clicks", saved={1: 20, 0: 10})
    assert json.loads(saved["startingOffsets"]) == {"clicks": {"0": 10, "1": 20}}
    assert saved["failOnDataLoss"] == "false"
    sink = feeds.kafka_sink_options("host:1", "out")
    assert sink == {"kafka.bootstrap.servers": "host:1", "topic": "out"}


VEHICLES = [
    ("k1", '{"gpstime":"2024-01-01 10:00:00","lon":1.5,"lat":2.0,"speaker":"s","mnetworkcode":"m"}'),
    ("k2", '{"gpstime":"2024-01-01 10:00:01","lon":9.0,"lat":2.0,"mnetworkcode":"m"}'),
]
RULES = [Rule("lon > 5", "speaker", "'far'"), Rule("speaker = 'far'", "lat", "lat + lon")]


@pytest.mark.parametrize("with_key", [True, False])
def test_publish(spark, job, with_key):
    spark.createDataFrame(VEHICLES, "key STRING, value STRING").write.parquet(f"{job.folder}/feed")
    out = f"{job.folder}/topic"
    columns = ["key", "value"] if with_key else ["value"]
    query = feeds.publish(
        job.feed(), "json", path=out, checkpoint=job.checkpoint, with_key=with_key, trigger=ONCE
    )
    query.awaitTermination()
    batch = feeds.read_clicks(spark, "parquet", path=f"{job.folder}/feed", streaming=False)
    assert feeds.publish(batch, "json", path=f"{out}-batch", with_key=with_key) is None
    for path in (out, f"{out}-batch"):
        got = spark.read.json(path)
        assert got.columns == columns
        assert rows(got) == rows(batch.select(*columns))
    with pytest.raises(ValueError, match="checkpoint"):
        feeds.publish(job.feed(), "json", path=out)


def test_enrichment_stream(spark, job):
    spark.createDataFrame(VEHICLES, "key STRING, value STRING").write.parquet(f"{job.folder}/feed")
    out = f"{job.folder}/topic"
    jobs.start_enrichment(job.feed(), RULES, job.checkpoint, "text", path=out, trigger=ONCE).awaitTermination()
    texts = spark.read.text(out)
    assert json.loads(rows(texts)[0][0])["gpstime"] == "2024-01-01 10:00:00"
    fields = parse_vehicles(texts).select("lon", "lat", "speaker", "mnetworkcode")
    assert rows(fields) == [(1.5, 2.0, "s", "m"), (9.0, 11.0, "far", "m")]


def test_enrichment_rejects_stream(spark, job):
    bad = [("k3", "{"), ("k4", '{"lat":"north"}')]
    spark.createDataFrame([*VEHICLES, *bad], "key STRING, value STRING").write.parquet(f"{job.folder}/feed")
    out = f"{job.folder}/rejects"
    jobs.start_enrichment_rejects(job.feed(), out, job.checkpoint, ONCE).awaitTermination()
    assert rows(spark.read.parquet(out)) == [("k3", "{", "malformed"), ("k4", bad[1][1], "wrong_type")]
