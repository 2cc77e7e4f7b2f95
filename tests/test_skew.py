"""Queries against their SQL on tables where one key holds a third of the rows."""

import os
import shutil

import duckdb
import pytest

import __spark_entry__ as entry_points
from compare import differences, duck
from rillwork.operators.ordered import GROUP_ROWS_CONF
from rillwork.plans.registry import TABLES

SOURCE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="tables are not here")

HOT = {
    "lineitem": {"l_orderkey": "17", "l_suppkey": "5", "l_partkey": "9"},
    "orders": {"o_custkey": "11", "o_orderdate": "TIMESTAMP '1998-10-05'"},
    "events": {"user_id": "7", "props": "'{\"k\": 3}'"},
    "customer": {"c_acctbal": "9999.0", "c_mktsegment": "'BUILDING'"},
    "part": {"p_brand": "'Brand#1'", "p_retailprice": "9999.0"},
    "supplier": {"s_nationkey": "3", "s_acctbal": "9999.0"},
}

SETTINGS = {
    GROUP_ROWS_CONF: "60",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}

NAMES = """dept_revenue_per_year avg_revenue_per_day product_revenue top5_products_per_year top3_customers_per_year
    top2_rank_per_category top5_price_dense status_orders_over busy_customers customers_without_orders rank_family
    visit_number centered_moving_average cumulative_sum lag_lead moving_average moving_average_dirty
    moving_average_with_info event_gaps dwell_seconds sessionize sequential_row_id scd2_merge api_share payment_join
    pair_join_right pair_join_full cogroup group_values broadcast_lookup subtract_keep_duplicates last_value_per_key
    fold_max_by_key""".split()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    target = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    for name in TABLES:
        source, copy = f"{SOURCE}/{name}.parquet", f"{target}/{name}.parquet"
        if name not in HOT:
            shutil.copyfile(source, copy)
            continue
        hot = ", ".join(
            f"CASE WHEN hash(n, '{column}') % 3 = 0 THEN {value} ELSE {column} END AS {column}"
            for column, value in HOT[name].items()
        )
        connection.execute(
            f"""COPY (SELECT * EXCLUDE (n) REPLACE ({hot}) FROM
            (SELECT *, row_number() OVER () AS n FROM '{source}')) TO '{copy}' (FORMAT parquet)"""
        )
    return str(target)


@pytest.fixture(scope="module")
def skewed(spark):
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    yield spark
    for name, value in before.items():
        if value is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.mark.parametrize("name", NAMES)
def test_query_on_skewed_tables(skewed, folder, name):
    query = entry_points.queries()[name](skewed, folder)
    assert differences(query, duck(folder), entry_points.oracle_sql()[name]) is None
