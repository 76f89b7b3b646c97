"""Every registered query runs; where SQL states the result, both agree."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from tests.oracle_compare import compare, connect

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "sales"] and df.count() > 60


@pytest.mark.parametrize("key", [k for k in QUERIES if k in ORACLES])
def test_equals_sql(spark, con, sf, key):
    assert compare(spark, con, sf, QUERIES[key], ORACLES[key]) == []


@pytest.mark.parametrize("key", [k for k in QUERIES if k not in ORACLES])
def test_runs(spark, sf, key):
    assert QUERIES[key](spark, sf).count() > 0
