"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference
from spanloom.plans import oracles, registry

QUERIES = registry.QUERIES
SQL = oracles.SQL


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, con):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["trace_id", "name", "duration_sec", "start_time"]
    assert df.count() > 0
