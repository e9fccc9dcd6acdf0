"""Every registered query against its SQL in DuckDB."""

import os

import pytest

import compare
from strataloom.catalog import ORACLE, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return compare.connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLE:
        assert compare.difference(df, con, ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(ORACLE) == set()


def test_difference_is_noticed(spark, con):
    df = QUERIES["g01_count"](spark, FOLDER)
    assert "first different row" in compare.difference(df, con, "SELECT COUNT(*) + 1 AS n FROM lineitem")
    assert "types" in compare.difference(df, con, "SELECT CAST(COUNT(*) AS INTEGER) AS n FROM lineitem")
    assert "columns" in compare.difference(df, con, "SELECT COUNT(*) AS m FROM lineitem")
    assert "rows" in compare.difference(df, con, "SELECT COUNT(*) AS n FROM lineitem WHERE FALSE HAVING FALSE")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["order_date", "n_name", "sale_count", "quantity", "revenue"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
