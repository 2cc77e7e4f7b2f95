"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import differences, duck

FOLDER = os.environ.get("QUERY_TEST_DIR", "/root/testdata/sf0.001")
QUERIES = entry_points.queries()
SQL = entry_points.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables are not here")


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    """Only operators on whole corpora may lack SQL; their own tests compare them by brute force."""
    assert set(SQL) <= set(QUERIES)
    assert all(n == "pipeline" or n.startswith("op") for n in set(QUERIES) - set(SQL))


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", SQL)
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) is None


def test_comparison_sees_differences(spark, connection):
    query = QUERIES["order_count"](spark, FOLDER)
    assert "difference" in differences(query, connection, "SELECT count(*) + 1 AS n FROM orders")
    assert "columns" in differences(query, connection, "SELECT count(*) AS m FROM orders")
    assert "type" in differences(query, connection, "SELECT CAST(count(*) AS DOUBLE) AS n FROM orders")
    assert "rows" in differences(query, connection, "SELECT count(*) AS n FROM orders GROUP BY o_orderstatus")
