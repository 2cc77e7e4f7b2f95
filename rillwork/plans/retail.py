"""Questions on orders, their lines, and the products, customers and places behind them.

Lines are added up per order, product or supplier before they meet another
table, so a hot key is combined on the map side and the later joins carry one
row per key.  Dimensions are joined last, without hints: Spark broadcasts one
when its size is known to be below the limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillwork.functions.money import as_amount, total
from rillwork.functions.times import within_days
from rillwork.operators.joins import without
from rillwork.operators.ordering import sorted_within, top_values
from rillwork.operators.sets import union_all
from rillwork.plans.registry import TABLES, Tables, money, query
from rillwork.sources.tables import sql_over

REVENUE = money("l_extendedprice")
LINES = "orders JOIN lineitem ON l_orderkey = o_orderkey"
PLACES = """JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
    JOIN region ON r_regionkey = n_regionkey"""
#: Years of the given tables, for the SQL that checks the pivot; the query itself finds its years.
YEARS = [str(y) for y in range(1995, 2002)]
PERIOD = ("1998-10-01", "1998-12-31")


def order_totals(t: Tables) -> DataFrame:
    """Revenue and number of lines per order; grouping and the join with orders share a shuffle."""
    return t.lineitem.groupBy("l_orderkey").agg(
        total("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )


def orders_with_totals(t: Tables, *columns) -> DataFrame:
    orders = t.orders.select("o_orderkey", *columns)
    return order_totals(t).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def lines_with_orders(t: Tables, *columns) -> DataFrame:
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(*columns)


def _year():
    return F.year("o_orderdate").alias("yr")


def _per_order():
    # There is one row per order, so counting rows counts orders.
    return as_amount(F.sum("revenue")) / F.count("l_orderkey")


@query("SELECT count(*) AS n FROM orders")
def order_count(t: Tables) -> DataFrame:
    return t.orders.agg(F.count(F.lit(1)).alias("n"))


@query(
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in TABLES)
)
def file_counts(t: Tables) -> DataFrame:
    sizes = [
        getattr(t, name).agg(F.count(F.lit(1)).alias("n")).withColumn("table_name", F.lit(name))
        for name in TABLES
    ]
    return union_all(sizes)


@query(f"SELECT {REVENUE} / count(DISTINCT l_orderkey) AS revenue_per_order FROM {LINES}")
def avg_revenue_per_order(t: Tables) -> DataFrame:
    return orders_with_totals(t).agg(_per_order().alias("revenue_per_order"))


@query(
    f"""SELECT CAST(o_orderdate AS DATE) AS day, {REVENUE} / count(DISTINCT l_orderkey) AS revenue_per_order
    FROM {LINES} GROUP BY 1 ORDER BY 1"""
)
def avg_revenue_per_day(t: Tables) -> DataFrame:
    day = F.to_date("o_orderdate").alias("day")
    return orders_with_totals(t, day).groupBy("day").agg(_per_order().alias("revenue_per_order")).orderBy("day")


@query(
    f"""SELECT CAST(month(o_orderdate) AS INTEGER) AS mnth,
        {REVENUE} / count(DISTINCT l_orderkey) AS revenue_per_order
    FROM {LINES} GROUP BY 1 ORDER BY 1"""
)
def avg_revenue_per_month(t: Tables) -> DataFrame:
    """Calendar months of all years together."""
    month = F.month("o_orderdate").alias("mnth")
    return orders_with_totals(t, month).groupBy("mnth").agg(_per_order().alias("revenue_per_order")).orderBy("mnth")


@query(
    f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mnth,
        {REVENUE} AS revenue FROM {LINES} GROUP BY 1, 2 ORDER BY 1, 2"""
)
def revenue_per_year_month(t: Tables) -> DataFrame:
    joined = orders_with_totals(t, _year(), F.month("o_orderdate").alias("mnth"))
    return joined.groupBy("yr", "mnth").agg(as_amount(F.sum("revenue")).alias("revenue")).orderBy("yr", "mnth")


def _department_years(t: Tables) -> DataFrame:
    """Revenue per department (region) and year, added up per supplier before the snowflake joins."""
    lines = lines_with_orders(t, "l_suppkey", _year(), "l_extendedprice")
    sold = lines.groupBy("l_suppkey", "yr").agg(total("l_extendedprice").alias("revenue"))
    places = (
        t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("department"))
    )
    return (
        sold.join(places, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("department", "yr")
        .agg(as_amount(F.sum("revenue")).alias("revenue"))
    )


@query(
    f"""SELECT r_name AS department, CAST(year(o_orderdate) AS INTEGER) AS yr, {REVENUE} AS revenue
    FROM {LINES} {PLACES} GROUP BY 1, 2 ORDER BY 1, 2"""
)
def dept_revenue_per_year(t: Tables) -> DataFrame:
    return _department_years(t).orderBy("department", "yr")


@query(
    f"""WITH d AS (SELECT r_name AS department, year(o_orderdate) AS yr, {REVENUE} AS revenue
        FROM {LINES} {PLACES} GROUP BY 1, 2)
    SELECT department, {", ".join(f'avg(revenue) FILTER (yr = {y}) AS "{y}"' for y in YEARS)}
    FROM d GROUP BY department"""
)
def pivot_dept_year(t: Tables) -> DataFrame:
    """A column per year that the orders have; the years are looked up first, which runs a job."""
    return _department_years(t).groupBy("department").pivot("yr").avg("revenue")


HIGHEST_PRICED = """SELECT p_name, p_retailprice FROM part
    WHERE p_retailprice = (SELECT max(p_retailprice) FROM part)"""


@query(HIGHEST_PRICED)
def highest_priced_part(t: Tables) -> DataFrame:
    return sql_over(HIGHEST_PRICED.replace("part", "{part}").replace("{part}_", "part_"), part=t.part)


@query(
    """SELECT * FROM (SELECT n_name, s_name, s_acctbal,
        rank() OVER (PARTITION BY n_name ORDER BY s_acctbal DESC) AS rank
        FROM supplier JOIN nation ON n_nationkey = s_nationkey) WHERE rank <= 2"""
)
def top2_rank_per_category(t: Tables) -> DataFrame:
    suppliers = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return top_values(suppliers.select("n_name", "s_name", "s_acctbal"), ["n_name"], "s_acctbal", 2, dense=False)


def _sold_products(t: Tables, **periods: Column) -> DataFrame:
    """Revenue and lines per product and period, with the product's name and type."""
    named = [period.alias(name) for name, period in periods.items()]
    lines = lines_with_orders(t, "l_partkey", *named, "l_extendedprice")
    sold = lines.groupBy("l_partkey", *periods).agg(
        total("l_extendedprice").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )
    parts = t.part.select("p_partkey", "p_name", "p_type")
    return sold.join(parts, F.col("l_partkey") == F.col("p_partkey"))


@query(
    f"""SELECT p_name, {REVENUE} AS revenue FROM {LINES} JOIN part ON p_partkey = l_partkey
    GROUP BY 1 ORDER BY 2 DESC"""
)
def product_revenue(t: Tables) -> DataFrame:
    revenue = as_amount(F.sum("revenue")).alias("revenue")
    return _sold_products(t).groupBy("p_name").agg(revenue).orderBy(F.col("revenue").desc(), "p_name")


@query(
    f"""SELECT * FROM (SELECT *, rank() OVER (PARTITION BY yr ORDER BY revenue DESC) AS rank FROM (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, p_name, {REVENUE} AS revenue
        FROM {LINES} JOIN part ON p_partkey = l_partkey GROUP BY 1, 2)) WHERE rank <= 5"""
)
def top5_products_per_year(t: Tables) -> DataFrame:
    revenue = as_amount(F.sum("revenue")).alias("revenue")
    products = _sold_products(t, yr=F.year("o_orderdate")).groupBy("yr", "p_name").agg(revenue)
    falling = Window.partitionBy("yr").orderBy(F.col("revenue").desc())
    # The rank limit is applied in every task before the rows of a year meet.
    ranked = products.withColumn("rank", F.rank().over(falling)).filter(F.col("rank") <= 5)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    f"""SELECT p_type, count(*) AS n FROM {LINES} JOIN part ON p_partkey = l_partkey
    GROUP BY 1 ORDER BY 2 DESC"""
)
def popular_categories(t: Tables) -> DataFrame:
    counted = _sold_products(t).groupBy("p_type").agg(F.sum("lines").alias("n"))
    return counted.orderBy(F.col("n").desc(), "p_type")


@query(
    f"""SELECT p_type, CAST(year(o_orderdate) AS INTEGER) AS yr, concat('Q_', quarter(o_orderdate)) AS qtr,
        {REVENUE} AS revenue FROM {LINES} JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3"""
)
def category_revenue_per_quarter(t: Tables) -> DataFrame:
    quarter = F.concat(F.lit("Q_"), F.quarter("o_orderdate").cast("string"))
    revenue = as_amount(F.sum("revenue")).alias("revenue")
    return _sold_products(t, yr=F.year("o_orderdate"), qtr=quarter).groupBy("p_type", "yr", "qtr").agg(revenue)


@query(
    f"""SELECT * FROM (SELECT o_orderkey, o_orderdate, {REVENUE} AS revenue FROM {LINES}
        WHERE o_orderstatus = 'P' GROUP BY 1, 2) WHERE revenue > 100000 ORDER BY revenue DESC"""
)
def status_orders_over(t: Tables) -> DataFrame:
    orders = t.orders.filter(F.col("o_orderstatus") == "P").select("o_orderkey", "o_orderdate")
    # Orders are filtered before their lines are added up.
    lines = t.lineitem.select("l_orderkey", "l_extendedprice")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    summed = joined.groupBy("o_orderkey", "o_orderdate").agg(as_amount(total("l_extendedprice")).alias("revenue"))
    return summed.filter(F.col("revenue") > 100000).orderBy(F.col("revenue").desc(), "o_orderkey")


@query(
    """SELECT p_brand, p_name, p_retailprice, p_partkey FROM part
    ORDER BY p_retailprice DESC, p_brand, p_partkey"""
)
def sort_parts_by_price(t: Tables) -> DataFrame:
    part = t.part.select("p_brand", "p_name", "p_retailprice", "p_partkey")
    return part.orderBy(F.col("p_retailprice").desc(), "p_brand", "p_partkey")


@query("SELECT p_brand, p_name, p_retailprice, p_partkey FROM part")
def sort_within_category(t: Tables) -> DataFrame:
    part = t.part.select("p_brand", "p_name", "p_retailprice", "p_partkey")
    return sorted_within(part, "p_brand", ["p_retailprice", "p_partkey"])


@query(
    """SELECT * FROM (SELECT p_brand, p_name, p_retailprice,
        dense_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC) AS rank FROM part)
    WHERE rank <= 5"""
)
def top5_price_dense(t: Tables) -> DataFrame:
    part = t.part.select("p_brand", "p_name", "p_retailprice")
    return top_values(part, ["p_brand"], "p_retailprice", 5, dense=True)


@query(
    f"""SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY yr ORDER BY revenue DESC) AS rank FROM (
        SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, concat(c_name, '_', c_mktsegment) AS name,
            {REVENUE} AS revenue
        FROM {LINES} JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2)) WHERE rank <= 3"""
)
def top3_customers_per_year(t: Tables) -> DataFrame:
    """Customers of the same name count as one, as they do in the question."""
    bought = orders_with_totals(t, "o_custkey", _year()).groupBy("o_custkey", "yr")
    bought = bought.agg(F.sum("revenue").alias("revenue"))
    name = F.concat_ws("_", "c_name", "c_mktsegment").alias("name")
    customers = t.customer.select("c_custkey", name)
    named = bought.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    sums = named.groupBy("yr", "name").agg(as_amount(F.sum("revenue")).alias("revenue"))
    falling = Window.partitionBy("yr").orderBy(F.col("revenue").desc())
    ranked = sums.withColumn("rank", F.dense_rank().over(falling)).filter(F.col("rank") <= 3)
    return ranked.withColumn("rank", F.col("rank").cast("bigint"))


def _ordered_in(t: Tables, first: str, last: str) -> DataFrame:
    """The customer of every line ordered in a period.

    A period is a small part of all orders, so lines are not added up first:
    Spark can then filter them by the period's orders before it shuffles them.
    """
    orders = t.orders.filter(within_days("o_orderdate", first, last)).select("o_orderkey", "o_custkey")
    lines = t.lineitem.select("l_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey")


PERIOD_SQL = "CAST(o_orderdate AS DATE) BETWEEN DATE '{}' AND DATE '{}'".format(*PERIOD)


@query(
    f"""SELECT * FROM customer WHERE c_custkey NOT IN
    (SELECT o_custkey FROM {LINES} WHERE {PERIOD_SQL})"""
)
def customers_without_orders(t: Tables) -> DataFrame:
    return without(t.customer, _ordered_in(t, *PERIOD), "c_custkey", "o_custkey")


@query(
    f"""SELECT o_custkey, count(o_custkey) AS line_count FROM {LINES} WHERE {PERIOD_SQL}
    GROUP BY 1 HAVING count(o_custkey) > 5 ORDER BY 2 DESC"""
)
def busy_customers(t: Tables) -> DataFrame:
    counted = _ordered_in(t, *PERIOD).groupBy("o_custkey").agg(F.count("o_custkey").alias("line_count"))
    busy = counted.filter(F.col("line_count") > 5)
    return busy.orderBy(F.col("line_count").desc(), "o_custkey")


