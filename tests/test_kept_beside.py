"""What is kept beside the counts: visitors, rules in versions, positions of the feed."""

from __future__ import annotations

import json
from pathlib import Path

import pytest

from clicktally.operators import clicks
from clicktally.operators.enrich import Rule
from clicktally.schemas import INDEX_CLICK_COUNT_SUM, PAGE_VISITORS
from clicktally.sources import feed as feeds
from clicktally.sources import ledger, rules, tables
from clicktally.sources.tables import ResultTable
from clicktally.streaming import jobs
from tests.conftest import rows

NOW = {"availableNow": True}


def test_visitors_of_any_span(spark, tmp_path):
    """Within the error of the sketch; a batch that comes again, and a fold, change nothing."""
    table = ResultTable(PAGE_VISITORS, str(tmp_path / "v"))
    days = [f"2024-01-{d:02}" for d in range(1, 11)]
    data = [(d, p, f"u{u}", 1 + u % 3) for i, d in enumerate(days) for p, n in (("a", 3000), ("b", 40)) for u in range(i * n // 4, i * n // 4 + n)]
    counts = spark.createDataFrame(data, "date string, position string, userid string, clickCount bigint")
    for batch, part in enumerate(("date < '2024-01-06'", "date >= '2024-01-06'", "date = '2024-01-03'")):
        for _ in range(2):
            tables.add_visitors(clicks.visitor_sketches(counts.filter(part)), table, batch)
    for first, last in (("2024-01-01", "2024-01-10"), ("2024-01-04", "2024-01-07"), ("2024-01-03", "2024-01-03"), ("2025-01-01", "2025-01-02")):
        exact = {r.position: r for r in clicks.exact_visitors(counts, first, last).collect()}
        before = clicks.span_visitors(tables.read_table(spark, table), first, last)
        got = {r.position: r for r in before.collect()}
        assert set(got) == set(exact)
        for p, r in exact.items():
            twice = sum(n for d, q, _, n in data if q == p and d == "2024-01-03" and first <= d <= last)
            assert got[p].pv == r.pv + twice and abs(got[p].uv - r.uv) <= 0.05 * r.uv
            assert r.uv == len({u for d, q, u, _ in data if q == p and first <= d <= last})
        kept = rows(before)
        tables.fold(spark, table, "2024-01-01", "2024-01-10")
        tables.remove_folded(spark, table)
        assert rows(clicks.span_visitors(tables.read_table(spark, table), first, last)) == kept
    with pytest.raises(ValueError, match="taken out"):
        tables.delete_keys(counts, table, 9)


def test_visitors_stream_starts_again(spark, tmp_path):
    feed = tmp_path / "feed"
    table, exact = ResultTable(PAGE_VISITORS, str(tmp_path / "v")), ResultTable(INDEX_CLICK_COUNT_SUM, str(tmp_path / "e"))
    for part in range(2):
        spark.createDataFrame([("2024-01-01", "a", f"u{u % 30}") for u in range(50 * (part + 1))], "date string, position string, userid string").write.mode("append").parquet(str(feed))
        stream = spark.readStream.schema("date string, position string, userid string").parquet(str(feed))
        jobs.start_visitors(stream, table, str(tmp_path / "c"), exact, NOW).awaitTermination()
    assert rows(clicks.span_visitors(tables.read_table(spark, table), "2024-01-01", "2024-01-01")) == [("a", 150, 30)]
    assert rows(clicks.exact_visitors(tables.read_table(spark, exact), "2024-01-01", "2024-01-01")) == [("a", 150, 30)]


def test_rules_are_checked_when_stored(spark, tmp_path):
    path = str(tmp_path / "rules")
    assert rules.read_rules(spark, path) == (0, [])
    good = [Rule("lon > 1", "speaker", "'far'"), Rule("speaker = 'far'", "lat", "lat * 2")]
    assert rules.store_rules(spark, path, good) == 1 and rules.read_rules(spark, path) == (1, good)
    for bad, why in (
        (Rule("lon >", "speaker", "'x'"), "rule 1"),
        (Rule("nothing = 1", "speaker", "'x'"), "rule 1"),
        (Rule("lon + 1", "speaker", "'x'"), "not boolean"),
        (Rule("lon > 1", "plate", "'x'"), "no column"),
        (Rule("lon > 1", "speaker", "upper("), "rule 1"),
    ):
        with pytest.raises(ValueError, match=why):
            rules.store_rules(spark, path, [good[0], bad])
    with pytest.raises(ValueError, match="one rule at least"):
        rules.store_rules(spark, path, [])
    assert rules.store_rules(spark, path, good[:1]) == 2
    assert rules.read_rules(spark, path) == (2, good[:1]) and rules.read_rules(spark, path, 1) == (1, good)
    with pytest.raises(ValueError, match="no version 7"):
        rules.read_rules(spark, path, 7)


def test_rules_change_while_a_stream_runs(spark, tmp_path):
    """A rule that is added after the start holds from the next batch on; a batch again has the rules it had."""
    feed, path = tmp_path / "feed", str(tmp_path / "rules")
    feed.mkdir()

    def arrive(n: int) -> None:
        spark.createDataFrame([(str(n), json.dumps({"lon": float(n), "x": "é"}))], "key string, value string").coalesce(1).write.mode("append").parquet(str(feed))

    def published() -> list[dict]:
        return sorted((json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()), key=lambda r: r["lon"])

    rules.store_rules(spark, path, [Rule("lon > 0", "speaker", "'one'")])
    arrive(1)
    stream = feeds.read_clicks(spark, "parquet", path=str(feed))
    query = jobs.start_stored_enrichment(stream, path, str(tmp_path / "c"), "text", path=str(tmp_path / "out"))
    try:
        query.processAllAvailable()
        rules.store_rules(spark, path, [Rule("lon > 1", "speaker", "'two'"), Rule("lon > 1", "lat", "1.5")])
        arrive(2)
        query.processAllAvailable()
    finally:
        query.stop()
        query.awaitTermination(30)
    want = [
        {"lon": 1.0, "speaker": "one", "rules_version": 1, "x": "é"},
        {"lon": 2.0, "speaker": "two", "lat": 1.5, "rules_version": 2, "x": "é"},
    ]
    assert published() == want
    # as after a driver that was lost before the end of its last batch
    commits = sorted((p for p in Path(tmp_path, "c/commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    rules.store_rules(spark, path, [Rule("lon > 1", "speaker", "'three'")])
    jobs.start_stored_enrichment(stream, path, str(tmp_path / "c"), "text", path=str(tmp_path / "out"), trigger=NOW).awaitTermination()
    assert published() == want


def test_ledger_of_a_file_source(spark, tmp_path):
    feed, path = tmp_path / "feed", str(tmp_path / "ledger")
    assert rows(ledger.read_ledger(spark, path)) == []

    def run(checkpoint: str, files: int) -> None:
        for i in range(files):
            spark.createDataFrame([(str(i), "{}")] * 3, "key string, value string").coalesce(1).write.mode("append").parquet(str(feed))
        stream = feeds.read_clicks(spark, "parquet", {"maxFilesPerTrigger": "1"}, path=str(feed))
        query = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / checkpoint)).trigger(**NOW).start()
        query.awaitTermination()
        assert ledger.record(spark, path, query) == files
        assert ledger.record(spark, path, query) == files  # again: nothing more

    run("one", 2)
    run("one", 1)
    kept = ledger.read_ledger(spark, path)
    assert kept.count() == 3 and kept.agg({"rows": "sum"}).first()[0] == 9
    assert ledger.faults(kept).count() == 0
    assert {r.batch for r in kept.collect()} == {0, 1, 2}


def test_skipped_and_repeated_ranges(spark):
    def row(query: str, batch: int, minute: int, part: str, start, end, run: str = "r"):
        return (query, run, batch, f"2024-01-01 00:{minute:02}:00", "topic", part, start, end, 1)

    data = [
        row("a", 0, 1, "t/0", None, 10), row("a", 1, 2, "t/0", 10, 20), row("a", 1, 3, "t/0", 10, 20, "s"), row("a", 2, 4, "t/0", 20, 30),
        row("b", 0, 5, "t/0", 35, 40), row("b", 1, 6, "t/0", 40, 41), row("c", 0, 7, "t/0", 38, 50), row("c", 1, 8, "t/0", 50, 60),
        row("a", 0, 1, "t/1", 0, 5), row("b", 0, 5, "t/1", 5, 6), row("d", 0, 9, "t/1", None, 3),
    ]
    table = spark.createDataFrame(data, ledger.LEDGER.replace("at timestamp", "at string")).selectExpr("*").withColumn("at", ledger.F.to_timestamp("at"))
    found = {(r.query, r.batch, r.part, r.fault, r.length) for r in ledger.faults(table).collect()}
    assert found == {("b", 0, "t/0", "gap", 5), ("c", 0, "t/0", "overlap", 3), ("d", 0, "t/1", "overlap", 6)}
    nested = dict(ledger._flat('{"topic":{"0":12,"1":7},"logOffset":3}'))
    assert nested == {"topic/0": 12, "topic/1": 7, "logOffset": 3} and not dict(ledger._flat(None)) and not dict(ledger._flat("-"))
