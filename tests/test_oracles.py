"""Every registered query against its SQL on DuckDB, over whole tables."""

import pytest
from conftest import SMALL
from oracle import compare, connect

import __spark_entry__ as entry

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in SQL:
        assert compare(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["key", "event_type", "value", "lsn", "props"]
    assert set(SQL) <= set(QUERIES)
