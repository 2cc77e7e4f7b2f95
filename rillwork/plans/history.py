"""Change-data merge on customers and their orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.operators.history import merge_history, merge_saved, save_history
from rillwork.plans.registry import Tables, query
from rillwork.session import shared_path
from rillwork.sources import versions

#: Orders before this day make the base, orders from it on the updates.
CUT = "1998-07-01"


def _base_and_updates(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers by their last order before the cut and from it on, in one pass over the orders.

    Dates are text; base dates are missing for one market segment.  An update is
    marked as one where the base has the customer.
    """
    day = F.to_date("o_orderdate")
    early = day < F.lit(CUT).cast("date")
    last = t.orders.groupBy("o_custkey").agg(
        F.max(F.when(early, day)).alias("before"), F.max(F.when(~early, day)).alias("after")
    )
    both = last.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    in_base = F.col("before").isNotNull() & F.col("c_custkey").isNotNull()
    date = F.when(F.col("c_mktsegment") != "MACHINERY", F.date_format("before", "MM-dd-yyyy"))
    base = both.filter(in_base).select("c_custkey", date.alias("last_update"), F.lit("A").alias("indicator"))
    updates = both.filter(F.col("after").isNotNull()).select(
        F.col("o_custkey").alias("c_custkey"),
        F.date_format("after", "MM-dd-yyyy").alias("last_update"),
        F.when(in_base, "U").otherwise("A").alias("indicator"),
    )
    return base, updates


@query(
    f"""WITH base AS (SELECT c_custkey, any_value(CASE WHEN c_mktsegment <> 'MACHINERY' THEN strftime(latest, '%Y-%m-%d')
            ELSE '0001-01-01' END) AS d
        FROM customer JOIN (SELECT o_custkey, max(o_orderdate) AS latest FROM orders
            WHERE CAST(o_orderdate AS DATE) < DATE '{CUT}' GROUP BY 1) ON o_custkey = c_custkey GROUP BY 1),
    updates AS (SELECT o_custkey AS c_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS d FROM orders
        WHERE CAST(o_orderdate AS DATE) >= DATE '{CUT}' GROUP BY 1)
    SELECT c_custkey, b.d AS last_update, coalesce(u.d, '9999-12-31') AS change_date,
        CASE WHEN u.d IS NULL THEN 'A' ELSE 'I' END AS indicator
    FROM base b LEFT JOIN updates u USING (c_custkey)
    UNION ALL
    SELECT c_custkey, d, '9999-12-31', 'A' FROM updates"""
)
def scd2_merge(t: Tables) -> DataFrame:
    return merge_history(*_base_and_updates(t), "c_custkey", "last_update", "indicator")


MANY_CHANGES_SQL = """WITH days AS (SELECT DISTINCT o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS d FROM orders),
    chained AS (SELECT *, lead(d) OVER (PARTITION BY o_custkey ORDER BY d) AS n FROM days)
    SELECT o_custkey, d AS last_update, coalesce(n, '9999-12-31') AS change_date,
        CASE WHEN n IS NULL THEN 'A' ELSE 'I' END AS indicator FROM chained"""


def _order_days(t: Tables) -> DataFrame:
    """A change of the customer on every day with an order, as text."""
    return t.orders.select(
        "o_custkey", F.date_format("o_orderdate", "MM-dd-yyyy").alias("last_update"), F.lit("U").alias("indicator"),
        (F.to_date("o_orderdate") < F.lit(CUT).cast("date")).alias("early"),
    )


@query(MANY_CHANGES_SQL)
def scd2_many_changes(t: Tables) -> DataFrame:
    """Histories of customers with any number of changes on both sides."""
    days = _order_days(t)
    return merge_history(days.filter("early"), days.filter("NOT early"), "o_custkey", "last_update", "indicator")


@query(MANY_CHANGES_SQL)
def scd2_saved_merge(t: Tables) -> DataFrame:
    """The same in a saved table, to which two sets of updates are merged, by ranges of customers."""
    days, path = _order_days(t), shared_path(t.spark, "history")
    names = "o_custkey", "last_update", "indicator"
    nothing = days.filter(F.lit(False))
    save_history(merge_history(days.filter("early"), nothing, *names), path, names[0])
    late, odd = days.filter("NOT early"), F.col("o_custkey") % 2 == 1
    for version, part in enumerate((late.filter(odd), late.filter(~odd)), 1):
        merge_saved(t.spark, path, part, *names[1:], version)
    return versions.read(t.spark, path)
