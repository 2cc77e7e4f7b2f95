"""Access-log reports on lines written from events and pages.

An event asks for the page its props name; an error event leaves a line that is
cut short, or one without a client address, which the parsers must pass over.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.operators import logs
from rillwork.plans.registry import Tables, query

REQUESTS_SQL = """WITH requests AS (
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time, user_id, event_type, value, url,
        concat('10.0.', user_id // 256, '.', user_id % 256) AS address
    FROM events JOIN pages ON page_id = CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT))
"""


def _requests(t: Tables) -> DataFrame:
    events = t.events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        "user_id",
        "event_type",
        "value",
        F.from_json("props", "k bigint")["k"].alias("k"),
        F.concat_ws(
            ".",
            F.lit("10.0"),
            F.floor(F.col("user_id") / 256).cast("string"),
            (F.col("user_id") % 256).cast("string"),
        ).alias("address"),
    )
    return events.join(t.pages.select("page_id", "url"), F.col("k") == F.col("page_id"))


def _balancer_lines(t: Tables) -> DataFrame:
    failed = F.col("event_type") == "error"
    head = [
        "time",
        F.lit("front"),
        "address",
        F.when(failed, F.lit("-")).otherwise(F.lit("10.1.0.1")),
        F.lit("0.1 0.2 0.3"),
        F.lit("200 200"),
        F.lit("34"),
        F.length("url").cast("string"),
    ]
    agent = F.lit("agent/1.0 (like a browser)")
    request = F.when(~failed, F.concat_ws(" ", F.lit("GET"), "url", F.lit("HTTP/1.1"), agent))
    return _requests(t).select(F.concat_ws(" ", *head, request).alias("value"))


@query(
    REQUESTS_SQL
    + """SELECT time, 'front' AS balancer, address AS client, '10.1.0.1' AS backend, '0.1' AS request_time,
        '0.2' AS backend_time, '0.3' AS response_time, '200' AS balancer_status, '200' AS backend_status,
        '34' AS received_bytes, CAST(length(url) AS VARCHAR) AS sent_bytes, 'GET' AS method, url AS link,
        'HTTP/1.1' AS protocol, 'agent/1.0' AS browser
    FROM requests WHERE event_type <> 'error'"""
)
def log_parse(t: Tables) -> DataFrame:
    return logs.balancer_log(_balancer_lines(t))


@query(
    REQUESTS_SQL
    + "SELECT url AS link, count(*) AS hits FROM requests WHERE event_type <> 'error' GROUP BY 1"
)
def api_hits(t: Tables) -> DataFrame:
    return logs.link_hits(logs.balancer_log(_balancer_lines(t)))


@query(
    REQUESTS_SQL
    + """, named AS (SELECT string_split(array_to_string(list_slice(string_split(url, '.'), 1, 3), '.'), '/')[-1]
        AS api FROM requests WHERE event_type <> 'error')
    SELECT api, count(api) AS n, CAST(count(api) AS DOUBLE) / (SELECT count(*) FROM named) * 100 AS percentage
    FROM named GROUP BY 1"""
)
def api_share(t: Tables) -> DataFrame:
    return logs.api_share(logs.balancer_log(_balancer_lines(t)))


def _combined_lines(t: Tables) -> DataFrame:
    client = F.when(F.col("event_type") == "error", F.lit("unknown")).otherwise(F.col("address"))
    parts = [
        client,
        F.lit("-"),
        F.col("user_id").cast("string"),
        F.concat(F.lit("["), "time"),
        F.lit("+0000]"),
        F.lit('"GET'),
        "url",
        F.lit('HTTP/1.1"'),
        F.lit("200"),
        F.length("url").cast("string"),
        F.lit('"-"'),
        F.lit('"agent/1.0'),
        F.lit('(like a browser)"'),
    ]
    return _requests(t).select(F.concat_ws(" ", *parts).alias("value"))


@query(REQUESTS_SQL + "SELECT DISTINCT address AS client FROM requests WHERE event_type <> 'error'")
def log_distinct_clients(t: Tables) -> DataFrame:
    return logs.distinct_clients(logs.combined_log(_combined_lines(t)))
