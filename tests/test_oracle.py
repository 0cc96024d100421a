"""Every registered query against its SQL, on the smallest tables."""

import sys

import pytest

from checks import compare, registered

TABLES = "/root/testdata/sf0.001"
QUERIES, SQL = registered.queries(), registered.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(TABLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, TABLES)
    if name in SQL:
        assert compare.compare(df, SQL[name], con) == []
    else:
        assert df.count() >= 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    import __spark_entry__

    assert "__spark_entry__" in sys.modules
    assert {"outcome", "fingerprint"} <= set(__spark_entry__.entry(spark).columns)
