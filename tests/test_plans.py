"""What the plans of the registered queries must look like to hold at scale."""

from __future__ import annotations

import re

from clicktally.operators import ads, clicks
from clicktally.plans import catalog, fixtures
from clicktally.schemas import INDEX_CLICK_COUNT
from clicktally.sources import tables
from clicktally.sources.tables import ResultTable

SMALL = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_are_combined_before_one_shuffle(spark):
    text = plan(catalog.click_count_batch(spark, SMALL))
    assert text.count("Exchange") == 1
    assert "partial_count(1)" in text


def test_only_needed_columns_are_read(spark):
    text = plan(catalog.minute_ad_counts(spark, SMALL))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in text
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,click)]" in text


def test_no_plan_uses_python_or_a_cartesian_product(spark):
    for query in (catalog.page_pv_uv, catalog.province_top3, catalog.parse_rejects, catalog.enrich_rules_json):
        text = plan(query(spark, SMALL))
        for word in ("Python", "Pandas", "Cartesian", "NestedLoop", "SortAggregate"):
            assert word not in text


def test_users_are_counted_before_the_region_join(spark):
    counts = ads.user_ad_counts(fixtures.ad_clicks(fixtures.events(spark, SMALL)))
    text = plan(ads.with_region(counts, fixtures.user_regions(spark, SMALL)))
    counted = text.index("HashAggregate")
    assert text.index("Join [userid#") < counted < text.index("parquet [ts#")


def test_visitors_need_no_distinct(spark):
    text = plan(clicks.page_pv_uv(catalog.click_count_all_positions(spark, SMALL)))
    assert "Expand" not in text
    assert text.count("Exchange") == 2


def test_merged_read_is_one_hash_aggregation(spark, tmp_path):
    table = ResultTable(INDEX_CLICK_COUNT, str(tmp_path / "t"))
    tables.upsert_overwrite(catalog.click_count_batch(spark, SMALL), table, 0)
    text = plan(tables.read_table(spark, table))
    assert "SortAggregate" not in text
    assert text.count("Exchange") == 1


def test_before_is_a_partition_filter(spark, tmp_path):
    table = ResultTable(INDEX_CLICK_COUNT, str(tmp_path / "t"))
    tables.upsert_overwrite(catalog.click_count_batch(spark, SMALL), table, 0)
    text = plan(tables.read_table(spark, table, before=(0, 1)))
    assert re.search(r"PartitionFilters: \[\(\(run#\d+L < 0\)", text)
