"""Windows, moving averages, gaps and sessions over events and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.times import year_month
from rillwork.operators import sessions, timeseries
from rillwork.operators.aggregates import fill_with_mean
from rillwork.operators.ordered import number_rows, ranks
from rillwork.plans.registry import Tables, query

BY_TIME = ["ts", "event_id"]
BY_USER = "(PARTITION BY user_id ORDER BY ts, event_id{})"
ONE_USER = 8
IDLE, CAP = 12 * 3600, 24 * 3600

SECOND = "CAST(epoch(date_trunc('second', {})) AS BIGINT)"
CENTS = "SUM(CAST(value AS DECIMAL(18,2))) OVER " + BY_USER


def _events(t: Tables) -> DataFrame:
    return t.events.select("user_id", "ts", "event_id", "value")


@query(
    """SELECT o_orderpriority, o_orderdate, o_orderkey,
        rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS rank,
        dense_rank() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS dense_rank,
        row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, o_orderkey) AS row_number
    FROM orders"""
)
def rank_family(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderpriority", "o_orderdate", "o_orderkey")
    return ranks(orders, ["o_orderpriority"], ["o_orderdate"], ["o_orderkey"])


@query(
    f"""WITH f AS (SELECT user_id, ts, event_id, value,
        CAST({CENTS.format(" ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING")} AS DOUBLE) AS frame_total,
        count(value) OVER {BY_USER.format(" ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING")} AS frame_rows
        FROM events)
    SELECT *, frame_total / frame_rows AS centred_average FROM f"""
)
def centered_moving_average(t: Tables) -> DataFrame:
    return timeseries.centred_average(_events(t), ["user_id"], BY_TIME, "value", places=2)


@query(
    f"""SELECT user_id, ts, event_id, value,
        CAST({CENTS.format(" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")} AS DOUBLE) AS cumulative_sum
    FROM events"""
)
def cumulative_sum(t: Tables) -> DataFrame:
    return timeseries.cumulative_sum(_events(t), ["user_id"], BY_TIME, "value", places=2)


@query(
    f"""SELECT user_id, ts, event_id, value, lag(value, 2) OVER {BY_USER.format("")} AS previous,
        lead(value, 2) OVER {BY_USER.format("")} AS ahead FROM events"""
)
def lag_lead(t: Tables) -> DataFrame:
    return timeseries.lag_lead(_events(t), ["user_id"], BY_TIME, "value", 2)


@query(
    """SELECT user_id, ts, event_id, rank() OVER (PARTITION BY user_id ORDER BY ts) AS visit,
        dense_rank() OVER (PARTITION BY user_id ORDER BY ts) AS distinct_visit FROM events"""
)
def visit_number(t: Tables) -> DataFrame:
    ranked = ranks(t.events.select("user_id", "ts", "event_id"), ["user_id"], ["ts"])
    return ranked.withColumnsRenamed({"rank": "visit", "dense_rank": "distinct_visit"})


def _average_sql(source: str, key: str, ts: str, tie: str, value: str, extra: str = "") -> str:
    frame = f"OVER (PARTITION BY {key} ORDER BY {ts}, {tie} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    return f"""SELECT * EXCLUDE (frame_rows) FROM (SELECT {key}, {ts}, {tie}, {value}{extra},
        round(avg({value}) {frame}, 2) AS moving_average, count({key}) {frame} AS frame_rows
        FROM {source}) WHERE frame_rows = 3"""


@query(_average_sql("events", "user_id", "ts", "event_id", "value"))
def moving_average(t: Tables) -> DataFrame:
    return timeseries.moving_average(_events(t), "user_id", BY_TIME, "value", 3)


@query(_average_sql("events", "user_id", "ts", "event_id", "value") + f" AND user_id = {ONE_USER}")
def moving_average_one_key(t: Tables) -> DataFrame:
    """Moving average of one user: the filter comes before the window, as it is on its key."""
    one = _events(t).filter(F.col("user_id") == ONE_USER)
    return timeseries.moving_average(one, "user_id", BY_TIME, "value", 3)


DIRTY = "CASE WHEN event_type = 'error' THEN 'null' ELSE CAST(value AS VARCHAR) END"


def _dirty_events(t: Tables) -> DataFrame:
    """Events whose values are text, the word null for errors."""
    text = F.when(F.col("event_type") == "error", F.lit("null")).otherwise(F.col("value").cast("string"))
    return t.events.select("user_id", "ts", "event_id", text.alias("value"))


@query(
    _average_sql(
        f"""(SELECT user_id, ts, event_id, TRY_CAST({DIRTY} AS DOUBLE) AS value FROM events
        WHERE TRY_CAST({DIRTY} AS DOUBLE) IS NOT NULL)""",
        "user_id",
        "ts",
        "event_id",
        "value",
    )
)
def moving_average_dirty(t: Tables) -> DataFrame:
    clean = timeseries.readable(_dirty_events(t), "value")
    return timeseries.moving_average(clean, "user_id", BY_TIME, "value", 3)


@query(
    "SELECT a.*, c_name, c_mktsegment FROM ("
    + _average_sql("orders", "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    + ") a JOIN customer ON c_custkey = o_custkey"
)
def moving_average_with_info(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    averages = timeseries.moving_average(
        orders, "o_custkey", ["o_orderdate", "o_orderkey"], "o_totalprice", 3
    )
    return timeseries.moving_average_with(
        averages, t.customer, "o_custkey", "c_custkey", ["c_name", "c_mktsegment"]
    )


@query(
    f"""SELECT user_id, ts, event_id,
        {SECOND.format("ts")} - lag({SECOND.format("ts")}) OVER {BY_USER.format("")} AS gap_seconds
    FROM events"""
)
def event_gaps(t: Tables) -> DataFrame:
    return timeseries.event_gaps(t.events.select("user_id", "ts", "event_id"), ["user_id"], BY_TIME)


DWELL_SQL = f"""SELECT user_id, ts, event_id, CAST(ts AS DATE) AS day,
    coalesce(lead({SECOND.format("ts")}) OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id),
        {SECOND.format("ts")}) - {SECOND.format("ts")} AS dwell_seconds FROM events"""


def _dwelled(t: Tables) -> DataFrame:
    return timeseries.dwell(t.events.select("user_id", "ts", "event_id"), "user_id", BY_TIME)


@query(DWELL_SQL)
def dwell_seconds(t: Tables) -> DataFrame:
    return _dwelled(t)


# Steps through each user's events one by one, as the definition does.
SESSIONS_SQL = f"""WITH RECURSIVE n AS (
    SELECT user_id, ts, event_id, {SECOND.format("ts")} AS sec,
        row_number() OVER {BY_USER.format("")} AS rn FROM events),
g AS (SELECT *, sec - lag(sec) OVER (PARTITION BY user_id ORDER BY rn) AS gap FROM n),
i AS (SELECT *, CASE WHEN gap IS NULL OR gap >= {IDLE} THEN 0 ELSE gap END AS i FROM g),
s AS (
    SELECT user_id, rn, CAST(0 AS BIGINT) AS j, CAST(1 AS BIGINT) AS k FROM i WHERE rn = 1
    UNION ALL
    SELECT i.user_id, i.rn, CASE WHEN i.i = 0 OR s.j + i.i >= {CAP} THEN 0 ELSE s.j + i.i END,
        CASE WHEN i.i = 0 OR s.j + i.i >= {CAP} THEN s.k + 1 ELSE s.k END
    FROM s JOIN i ON i.user_id = s.user_id AND i.rn = s.rn + 1),
sessions AS (SELECT i.user_id, i.ts, i.event_id, concat(i.user_id, '--', s.k) AS session_id
    FROM i JOIN s ON s.user_id = i.user_id AND s.rn = i.rn)
"""


def _sessions(t: Tables) -> DataFrame:
    events = t.events.select("user_id", "ts", "event_id")
    return sessions.sessionize(events, "user_id", "ts", "event_id", IDLE, CAP)


@query(SESSIONS_SQL + "SELECT * FROM sessions")
def sessionize(t: Tables) -> DataFrame:
    return _sessions(t)


@query(
    SESSIONS_SQL
    + "SELECT CAST(ts AS DATE) AS day, count(DISTINCT session_id) AS sessions FROM sessions GROUP BY 1"
)
def sessions_per_day(t: Tables) -> DataFrame:
    return sessions.sessions_per_day(_sessions(t), "ts")


@query(
    f"""SELECT user_id, day, CAST(sum(dwell_seconds) AS DOUBLE) / 60 AS minutes
    FROM ({DWELL_SQL}) GROUP BY 1, 2"""
)
def time_spent_per_day(t: Tables) -> DataFrame:
    return sessions.time_spent(_dwelled(t), "user_id", "day")


@query(
    f"""SELECT user_id, concat(year(day), '_', month(day)) AS month,
        CAST(sum(dwell_seconds) AS DOUBLE) / 60 AS minutes FROM ({DWELL_SQL}) GROUP BY 1, 2"""
)
def time_spent_per_month(t: Tables) -> DataFrame:
    return sessions.time_spent(_dwelled(t).withColumn("month", year_month("ts")), "user_id", "month")


@query(
    f"""WITH d AS (SELECT user_id, ts, event_id, TRY_CAST({DIRTY} AS DOUBLE) AS value FROM events)
    SELECT user_id, ts, event_id, coalesce(value, (SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)
        / count(value) FROM d)) AS value FROM d"""
)
def fill_mean(t: Tables) -> DataFrame:
    dirty = _dirty_events(t).withColumn("value", F.expr("try_cast(value AS DOUBLE)"))
    return fill_with_mean(dirty, "value", places=2)


@query(
    """SELECT o_orderkey, c_name, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS row_id
    FROM orders JOIN customer ON c_custkey = o_custkey"""
)
def sequential_row_id(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    joined = orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return number_rows(joined.select("o_orderkey", "c_name", "o_totalprice"), ["o_orderkey"])
