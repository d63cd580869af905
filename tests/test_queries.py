"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from clicktally.plans import catalog
from tests.oracle import compare, connect

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLE)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(catalog.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, SMALL) > 0


def test_entry(spark):
    result = entry.entry(spark)
    assert result.columns == ["date", "position", "userid", "clickCount"]
    assert result.count() > 0
