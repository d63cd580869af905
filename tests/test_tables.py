from __future__ import annotations

import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clicktally.schemas import (
    AD_BLACKLIST,
    AD_CLICK_TREND,
    AD_PROVINCE_TOP3,
    AD_USER_CLICK_COUNT,
    INDEX_CLICK_COUNT,
    INDEX_CLICK_COUNT_ROWS,
    TABLES,
)
from clicktally.sources import tables
from clicktally.sources.tables import ResultTable
from tests.conftest import rows


@pytest.fixture
def kept(tmp_path):
    return lambda spec: ResultTable(spec, str(tmp_path / uuid.uuid4().hex))


def frame(spark, spec, *data):
    return spark.createDataFrame(list(data), spec.schema)


def test_table_list():
    assert sorted(TABLES) == [
        "ad_blacklist",
        "ad_click_trend",
        "ad_province_top3",
        "ad_stat",
        "ad_user_click_count",
        "index_gid_click_count",
    ]


def test_missing_table_is_empty(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    assert tables.is_empty(spark, table)
    assert rows(tables.read_table(spark, table)) == []
    assert tables.read_table(spark, table).schema.names == INDEX_CLICK_COUNT.schema.names


def test_overwrite_updates_inserts_and_keeps(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    d = "2024-01-01"
    tables.upsert_overwrite(
        frame(spark, table.spec, (d, "a", "1", 5), (d, "a", "2", 7), ("2024-01-02", "a", "1", 1)), table, 0
    )
    tables.upsert_overwrite(frame(spark, table.spec, (d, "a", "1", 3), (d, "b", "1", 9)), table, 1)
    expected = [(d, "a", "1", 3), (d, "a", "2", 7), (d, "b", "1", 9), ("2024-01-02", "a", "1", 1)]
    assert rows(tables.read_table(spark, table)) == expected
    before = [(d, "a", "1", 5), (d, "a", "2", 7), ("2024-01-02", "a", "1", 1)]
    assert rows(tables.read_table(spark, table, before=(0, 1))) == before
    assert tables.batch_rows(spark, table, 1) == 2
    assert not tables.is_empty(spark, table)


def test_later_run_wins_over_earlier_batches(spark, kept):
    table = kept(AD_CLICK_TREND)
    tables.upsert_overwrite(frame(spark, table.spec, ("2024-01-01", "00", "01", 1, 10)), table, 7, run=0)
    tables.upsert_overwrite(frame(spark, table.spec, ("2024-01-01", "00", "01", 1, 2)), table, 0, run=1)
    assert rows(tables.read_table(spark, table)) == [("2024-01-01", "00", "01", 1, 2)]


def test_repeated_batch_replaces_itself_whole(spark, kept):
    """Also where the repeat has fewer dates than the first, lost delivery had."""
    table = kept(AD_USER_CLICK_COUNT)
    tables.upsert_accumulate(frame(spark, table.spec, ("2024-01-01", 1, 1, 4)), table, 0)
    tables.upsert_accumulate(
        frame(spark, table.spec, ("2024-01-01", 1, 1, 2), ("2024-01-02", 1, 1, 2)), table, 1
    )
    for _ in range(2):
        tables.upsert_accumulate(frame(spark, table.spec, ("2024-01-01", 1, 1, 3)), table, 1)
    assert rows(tables.read_table(spark, table)) == [("2024-01-01", 1, 1, 7)]


def test_accumulate_sums_repeated_keys_of_a_batch(spark, kept):
    table = kept(AD_USER_CLICK_COUNT)
    row = ("2024-01-01", 1, 1, 2)
    tables.upsert_accumulate(frame(spark, table.spec, row, row, row), table, 0)
    tables.upsert_accumulate(frame(spark, table.spec, row), table, 1)
    assert rows(tables.read_table(spark, table)) == [("2024-01-01", 1, 1, 8)]


def test_append_keeps_everything_once_per_batch(spark, kept):
    table = kept(AD_BLACKLIST)
    for batch, ids in ((0, (1, 2, 2)), (1, (2, 3)), (1, (2, 3))):
        tables.append(frame(spark, table.spec, *((i,) for i in ids)), table, batch)
    assert rows(tables.read_table(spark, table)) == [(1,), (2,), (2,), (2,), (3,)]


def test_append_of_counts_does_not_merge(spark, kept):
    table = kept(INDEX_CLICK_COUNT_ROWS)
    row = ("2024-01-01", "a", "1", 5)
    tables.append(frame(spark, table.spec, row), table, 0)
    tables.append(frame(spark, table.spec, row), table, 1)
    assert rows(tables.read_table(spark, table)) == [row, row]


def test_append_takes_null_key_parts_but_no_empty_date(spark, kept):
    table = kept(INDEX_CLICK_COUNT_ROWS)
    data = [(None, "a", "1", 5), ("2024-01-01", None, None, None)]
    tables.append(frame(spark, table.spec, *data), table, 0)
    assert rows(tables.read_table(spark, table)) == sorted(data, key=repr)
    with pytest.raises(PySparkException, match="empty date"):
        tables.append(frame(spark, table.spec, ("", "a", "1", 5)), table, 1)


def test_replace_groups(spark, kept):
    table = kept(AD_PROVINCE_TOP3)
    d1, d2 = "2024-01-01", "2024-01-02"
    tables.replace_groups(
        frame(spark, table.spec, (d1, "x", 1, 9), (d1, "x", 2, 8), (d1, "y_z", 1, 4), (d2, "x", 3, 3)), table, 0
    )
    for _ in range(2):  # delivered twice
        tables.replace_groups(frame(spark, table.spec, (d1, "x", 5, 1), (d1, "x", 5, 1)), table, 1)
    expected = [(d1, "x", 5, 1), (d1, "x", 5, 1), (d1, "y_z", 1, 4), (d2, "x", 3, 3)]
    assert rows(tables.read_table(spark, table)) == expected


def test_group_parts_may_hold_anything_but_null(spark, kept):
    table = kept(AD_PROVINCE_TOP3)
    data = [("2024-01-01", p, 1, 1) for p in ("", "a/b=c", "null", "__HIVE_DEFAULT_PARTITION__", " ")]
    tables.replace_groups(frame(spark, table.spec, *data), table, 0)
    assert rows(tables.read_table(spark, table)) == sorted(data, key=repr)


@pytest.mark.parametrize("key", [(None, "a", "1"), ("", "a", "1"), ("2024-01-01", None, "1"), ("2024-01-01", "a", None)])
@pytest.mark.parametrize("unique", [False, True])
def test_overwrite_refuses_missing_key_parts(spark, kept, key, unique):
    table = kept(INDEX_CLICK_COUNT)
    with pytest.raises(PySparkException, match="missing part"):
        tables.upsert_overwrite(frame(spark, table.spec, (*key, 1)), table, 0, unique=unique)
    assert tables.is_empty(spark, table)


def test_accumulate_and_replace_refuse_missing_key_parts(spark, kept):
    table = kept(AD_USER_CLICK_COUNT)
    with pytest.raises(PySparkException, match="missing part"):
        tables.upsert_accumulate(frame(spark, table.spec, ("2024-01-01", None, 1, 1)), table, 0)
    table = kept(AD_PROVINCE_TOP3)
    with pytest.raises(PySparkException, match="missing part"):
        tables.replace_groups(frame(spark, table.spec, ("2024-01-01", None, 1, 1)), table, 0)


def test_overwrite_refuses_a_key_given_twice(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    row = ("2024-01-01", "a", "1", 5)
    with pytest.raises(PySparkException, match="comes twice"):
        tables.upsert_overwrite(frame(spark, table.spec, row, row), table, 0)


def test_wrong_kind_and_wrong_numbers(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    data = frame(spark, table.spec)
    with pytest.raises(ValueError, match="kept by 'latest'"):
        tables.append(data, table, 0)
    with pytest.raises(ValueError, match="negative"):
        tables.upsert_overwrite(data, table, -1)


def test_empty_batch(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    tables.upsert_overwrite(frame(spark, table.spec), table, 0)
    assert tables.is_empty(spark, table)
    tables.upsert_overwrite(frame(spark, table.spec, ("2024-01-01", "a", "1", 5)), table, 1)
    tables.upsert_overwrite(frame(spark, table.spec), table, 2)
    assert rows(tables.read_table(spark, table)) == [("2024-01-01", "a", "1", 5)]


def test_date_filter_reaches_the_partitions(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    data = [(f"2024-01-0{i}", "a", "1", i) for i in range(1, 5)]
    tables.upsert_overwrite(frame(spark, table.spec, *data), table, 0)
    one_day = tables.read_table(spark, table).filter(F.col("date") == "2024-01-02")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert rows(one_day) == [data[1]]


@pytest.mark.parametrize("batches, again", [(1, False), (3, True)])
def test_compact_keeps_the_rows(spark, kept, batches, again):
    d = "2024-01-01"
    for spec, write, data in (
        (AD_USER_CLICK_COUNT, tables.upsert_accumulate, [(d, 1, 1, 2), (d, 2, 1, 3)]),
        (INDEX_CLICK_COUNT, tables.upsert_overwrite, [(d, "a", "1", 2), (d, "a", "2", 3)]),
        (AD_PROVINCE_TOP3, tables.replace_groups, [(d, "x", 1, 2), (d, "x", 1, 2), (d, "y", 1, 1)]),
        (AD_BLACKLIST, tables.append, [(1,), (1,)]),
    ):
        table = kept(spec)
        for batch in range(batches):
            write(frame(spark, spec, *data), table, batch)
        expected = rows(tables.read_table(spark, table))
        small = tables.compact(spark, table, kept(spec).path)
        if again:
            small = tables.compact(spark, small, kept(spec).path)
        assert rows(tables.read_table(spark, small)) == expected
        # The last batch delivered again, then a new one: as if the table had not been compacted.
        for batch in (batches - 1, batches):
            write(frame(spark, spec, *data[:1]), table, batch)
            write(frame(spark, spec, *data[:1]), small, batch)
        assert rows(tables.read_table(spark, small)) == rows(tables.read_table(spark, table))
        with pytest.raises(ValueError, match="holds a table already"):
            tables.compact(spark, table, small.path)


def test_compact_of_nothing(spark, kept):
    table = kept(INDEX_CLICK_COUNT)
    assert tables.is_empty(spark, tables.compact(spark, table, kept(table.spec).path))


def test_export(spark, tmp_path):
    data = [("2024-01-01", 1), ("2024-01-02", 2)]
    df = spark.createDataFrame(data, "date STRING, n BIGINT")
    tables.export(df, "json", path=str(tmp_path / "plain"))
    tables.export(df, "parquet", partition_by=["date"], path=str(tmp_path / "parts"))
    assert rows(spark.read.schema(df.schema).json(str(tmp_path / "plain"))) == data
    parts = spark.read.schema(df.schema).parquet(str(tmp_path / "parts"))
    assert rows(parts.select("date", "n")) == data
    assert (tmp_path / "parts" / "date=2024-01-01").is_dir()


_KEYS = st.tuples(st.sampled_from(["2024-01-01", "2024-01-02"]), st.integers(0, 1), st.integers(0, 1))
_BATCH = st.dictionaries(_KEYS, st.integers(1, 9), max_size=4)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), _BATCH), min_size=1, max_size=4))
def test_tables_equal_a_plain_model(spark, kept, deliveries):
    """Any order of deliveries, repeats included, equals dictionaries kept by hand."""
    summed, newest = kept(AD_USER_CLICK_COUNT), kept(INDEX_CLICK_COUNT)
    by_batch: dict[int, dict] = {}
    for batch, counts in deliveries:
        by_batch[batch] = counts
        data = [(*k, n) for k, n in counts.items()]
        tables.upsert_accumulate(frame(spark, summed.spec, *data), summed, batch)
        texts = [(d, str(u), str(a), n) for d, u, a, n in data]
        tables.upsert_overwrite(frame(spark, newest.spec, *texts), newest, batch)
    sums: dict = {}
    last: dict = {}
    for batch in sorted(by_batch):
        for (d, u, a), n in by_batch[batch].items():
            sums[d, u, a] = sums.get((d, u, a), 0) + n
            last[d, str(u), str(a)] = n
    assert rows(tables.read_table(spark, summed)) == sorted(((*k, n) for k, n in sums.items()), key=repr)
    assert rows(tables.read_table(spark, newest)) == sorted(((*k, n) for k, n in last.items()), key=repr)
