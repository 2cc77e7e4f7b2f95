"""Access-log lines to columns and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.text import api_name
from rillwork.operators.aggregates import share_of_total

# A load-balancer line is 14 blank-separated fields and a remainder;
# a combined-format line starts with a dotted address, has ten more fields and a
# remainder.
BALANCER_LINE = r"^(\S+ ){14}.*$"
COMBINED_LINE = r"^[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+ \S+ \S+( \S*){7} .*$"

BALANCER_FIELDS = (
    "time",
    "balancer",
    "client",
    "backend",
    "request_time",
    "backend_time",
    "response_time",
    "balancer_status",
    "backend_status",
    "received_bytes",
    "sent_bytes",
    "method",
    "link",
    "protocol",
    "browser",
)
COMBINED_FIELDS = (
    "client",
    "identity",
    "user",
    "time",
    "zone",
    "method",
    "link",
    "protocol",
    "status",
    "sent_bytes",
    "referer",
    "agent",
)


def _fields(lines: DataFrame, line: str, pattern: str, names: tuple[str, ...]) -> DataFrame:
    matching = lines.filter(F.col(line).rlike(pattern)).select(F.split(line, " ").alias("_f"))
    return matching.select(*[F.get("_f", i).alias(n) for i, n in enumerate(names)])


def balancer_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Well-formed load-balancer lines as columns; the browser is the agent's first token."""
    return _fields(lines, line, BALANCER_LINE, BALANCER_FIELDS)


def combined_log(lines: DataFrame, line: str = "value") -> DataFrame:
    """Well-formed combined-format lines as columns, null where a line has fewer fields."""
    return _fields(lines, line, COMBINED_LINE, COMBINED_FIELDS)


def link_hits(log: DataFrame) -> DataFrame:
    """Requests per link, most requested first."""
    hits = log.groupBy("link").agg(F.count(F.lit(1)).alias("hits"))
    return hits.orderBy(F.col("hits").desc_nulls_last(), "link")


def api_share(log: DataFrame) -> DataFrame:
    """Requests per API and their percentage of all requests, most requested first."""
    shares = share_of_total(log.select(api_name("link").alias("api")), ["api"], "api")
    return shares.orderBy(F.col("n").desc(), "api")


def distinct_clients(log: DataFrame) -> DataFrame:
    return log.select("client").distinct()
