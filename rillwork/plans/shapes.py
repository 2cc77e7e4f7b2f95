"""Pivot, unpivot, explode, nested fields, JSON, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions import messages
from rillwork.functions.text import lines, token, words
from rillwork.operators import reshape
from rillwork.operators.joins import listed
from rillwork.plans.registry import Tables, money, query


def _priced(t: Tables) -> DataFrame:
    return t.orders.select("o_orderpriority", "o_orderstatus", "o_totalprice")


def _pivot_sql(*statuses: str) -> str:
    columns = ", ".join(
        f"CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) FILTER (o_orderstatus = '{s}') AS DOUBLE) AS \"{s}\""
        for s in statuses
    )
    return f"SELECT o_orderpriority, {columns} FROM orders GROUP BY 1"


@query(_pivot_sql("F", "O", "P"))
def pivot_sum(t: Tables) -> DataFrame:
    return reshape.pivot_total(_priced(t), "o_orderpriority", "o_orderstatus", "o_totalprice", places=2)


@query(_pivot_sql("P", "Z"))
def pivot_selected(t: Tables) -> DataFrame:
    """Only the statuses asked for, one of which no order has."""
    return reshape.pivot_total(_priced(t), "o_orderpriority", "o_orderstatus", "o_totalprice", ["P", "Z"], places=2)


@query(
    f"""SELECT o_orderpriority, 'pending' AS status, {money("o_totalprice")} AS total FROM orders
    WHERE o_orderstatus = 'P' GROUP BY 1
    UNION ALL SELECT o_orderpriority, o_orderstatus, {money("o_totalprice")} FROM orders
    WHERE o_orderstatus IN ('F', 'O') GROUP BY 1, 2"""
)
def unpivot_stack(t: Tables) -> DataFrame:
    turned = reshape.pivot_total(
        _priced(t), "o_orderpriority", "o_orderstatus", "o_totalprice", ["F", "O", "P", "Z"], places=2
    )
    labels = {"P": "pending", "F": "F", "O": "O", "Z": "Z"}
    return reshape.unpivot(turned, "o_orderpriority", labels, "status", "total")


# Lines of every text, French ones with a null at the end; besides, under negative
# numbers, rows without lines: null for German texts, an empty list for Spanish ones.
LINES_SQL = """(SELECT doc_id, CASE lang WHEN 'fr' THEN list_append(string_split(text, chr(10)), NULL)
        ELSE string_split(text, chr(10)) END AS lines FROM documents
    UNION ALL SELECT -1 - doc_id, CASE lang WHEN 'es' THEN CAST([] AS VARCHAR[]) END
    FROM documents WHERE lang IN ('de', 'es'))"""
LINE_ROWS_SQL = f"""SELECT doc_id, {{}} unnest(lines) AS line FROM {LINES_SQL}"""
POS_SQL = "CAST(unnest(range(len(lines))) AS INTEGER) AS pos,"
NO_LINES_SQL = f" UNION ALL SELECT doc_id, {{}} NULL FROM {LINES_SQL} WHERE lines IS NULL OR len(lines) = 0"


def _line_lists(t: Tables) -> DataFrame:
    all_lines = lines("text")
    with_null = F.array_append(all_lines, F.lit(None).cast("string"))
    full = t.documents.select("doc_id", F.when(F.col("lang") == "fr", with_null).otherwise(all_lines).alias("lines"))
    empty = F.when(F.col("lang") == "es", F.array().cast("array<string>"))
    without = t.documents.filter(F.col("lang").isin("de", "es")).select((-1 - F.col("doc_id")).alias("doc_id"), empty.alias("lines"))
    return full.unionAll(without)


@query(LINE_ROWS_SQL.format(""))
def explode_array(t: Tables) -> DataFrame:
    return reshape.explode_array(_line_lists(t), ["doc_id"], "lines", "line")


@query(LINE_ROWS_SQL.format("") + NO_LINES_SQL.format(""))
def explode_array_outer(t: Tables) -> DataFrame:
    return reshape.explode_array(_line_lists(t), ["doc_id"], "lines", "line", outer=True)


@query(LINE_ROWS_SQL.format(POS_SQL) + NO_LINES_SQL.format("NULL,"))
def posexplode_array_outer(t: Tables) -> DataFrame:
    return reshape.explode_array(_line_lists(t), ["doc_id"], "lines", "line", outer=True, position=True)


# The props of every event as a map, sign-ups with a second entry without a value;
# besides, under negative numbers, null for errors and an empty map for views.
K_SQL = "CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS INTEGER)"
ENTRIES_SQL = f"""SELECT event_id, 0 AS pos, 'k' AS key, {K_SQL} AS value FROM events
    UNION ALL SELECT event_id, 1, 'eye', NULL FROM events WHERE event_type = 'signup'"""
NO_ENTRIES_SQL = """ UNION ALL SELECT -1 - event_id, NULL, NULL, NULL FROM events
    WHERE event_type IN ('error', 'view')"""


def _maps(t: Tables) -> DataFrame:
    props = F.from_json("props", "map<string,int>")
    no_value = F.create_map(F.lit("eye"), F.lit(None).cast("int"))
    entries = F.when(F.col("event_type") == "signup", F.map_concat(props, no_value)).otherwise(props)
    full = t.events.select("event_id", entries.alias("features"))
    empty = F.when(F.col("event_type") == "view", F.create_map().cast("map<string,int>"))
    without = t.events.filter(F.col("event_type").isin("error", "view")).select((-1 - F.col("event_id")).alias("event_id"), empty.alias("features"))
    return full.unionAll(without)


@query(f"SELECT event_id, key, value FROM ({ENTRIES_SQL})")
def explode_map(t: Tables) -> DataFrame:
    return reshape.explode_map(_maps(t), ["event_id"], "features")


@query(f"SELECT event_id, key, value FROM ({ENTRIES_SQL}{NO_ENTRIES_SQL})")
def explode_map_outer(t: Tables) -> DataFrame:
    return reshape.explode_map(_maps(t), ["event_id"], "features", outer=True)


@query(ENTRIES_SQL + NO_ENTRIES_SQL)
def posexplode_map_outer(t: Tables) -> DataFrame:
    return reshape.explode_map(_maps(t), ["event_id"], "features", outer=True, position=True)


@query(
    """SELECT doc_id, list_filter(regexp_split_to_array(text, '[ \n]'), lambda w: w <> '')[1] AS first_word,
        list_filter(regexp_split_to_array(text, '[ \n]'), lambda w: w <> '')[501] AS late_word,
        lang AS lang_item, CAST(NULL AS VARCHAR) AS missing_item FROM documents"""
)
def collection_items(t: Tables) -> DataFrame:
    """Items of a list and a map, null where there is none."""
    features = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    items = t.documents.select("doc_id", words("text").alias("w"), features.alias("m"))
    return items.select(
        "doc_id",
        F.get("w", 0).alias("first_word"),
        F.get("w", 500).alias("late_word"),
        F.col("m")["lang"].alias("lang_item"),
        F.col("m")["hair"].alias("missing_item"),
    )


@query(
    """SELECT s_suppkey, n_name, n_regionkey FROM supplier JOIN nation ON n_nationkey = s_nationkey"""
)
def struct_fields(t: Tables) -> DataFrame:
    place = F.struct("n_name", "n_regionkey").alias("place")
    nested = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", place)
    return nested.select("s_suppkey", "place.n_name", "place.n_regionkey")


@query(f"SELECT event_id, CASE WHEN event_type <> 'error' THEN {K_SQL} END AS k FROM events")
def json_decode(t: Tables) -> DataFrame:
    """Typed field of a JSON text; errors have theirs cut short and give null."""
    cut = F.when(F.col("event_type") == "error", F.rtrim(F.col("props"), F.lit("}"))).otherwise(F.col("props"))
    decoded = t.events.select("event_id", F.from_json(cut, "k int").alias("data"))
    return decoded.select("event_id", "data.*")


LINKS_SQL = """(SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS links FROM pages)"""
ENTRY_ROWS_SQL = f"""SELECT page_id, len(links) AS records_total,
    CAST(unnest(range(1, len(links) + 1)) AS INTEGER) AS ordinal, unnest(links) AS name FROM {LINKS_SQL}"""


def _envelopes(t: Tables) -> DataFrame:
    """Each page's links as one JSON document ``{"recordsTotal": n, "data": [{"name": ..}, ..]}``."""
    found = t.pages.select("page_id", F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)).alias("links"))
    data = F.transform("links", lambda link: F.struct(link.alias("name")))
    document = F.to_json(F.struct(F.size("links").alias("recordsTotal"), data.alias("data")))
    return found.select("page_id", document.alias("document"))


def _entries(t: Tables) -> DataFrame:
    return reshape.flatten_envelope(_envelopes(t), ["page_id"], "document", "name string")


@query(ENTRY_ROWS_SQL)
def envelope_flatten(t: Tables) -> DataFrame:
    return _entries(t)


@query(f"SELECT * FROM ({ENTRY_ROWS_SQL}) WHERE ordinal IN (1, 3, 5)")
def envelope_select(t: Tables) -> DataFrame:
    return listed(_entries(t), "ordinal", [1, 3, 5])


@query(
    """SELECT page_id, string_split(url, '/')[3] AS host, upper(url) AS upper_url,
        trim(concat('  ', url, ' ')) AS trimmed,
        concat('Q_', page_id) AS label, regexp_full_match(url, 'https://.*') AS secure,
        array_to_string(list_slice(string_split(url, '.'), 1, 2), '.') AS two_parts,
        string_split(url, '/')[-1] AS last_part FROM pages"""
)
def string_functions(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        token("url", 2, "/").alias("host"),
        F.upper("url").alias("upper_url"),
        F.trim(F.concat(F.lit("  "), "url", F.lit(" "))).alias("trimmed"),
        F.concat(F.lit("Q_"), F.col("page_id").cast("string")).alias("label"),
        F.col("url").rlike("^https://.*$").alias("secure"),
        F.substring_index("url", ".", 2).alias("two_parts"),
        F.substring_index("url", "/", -1).alias("last_part"),
    )


@query(
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS yr,
        CAST(month(o_orderdate) AS INTEGER) AS mnth, CAST(quarter(o_orderdate) AS INTEGER) AS qtr,
        strftime(o_orderdate, '%m-%d-%Y') AS us_date, CAST(epoch(o_orderdate) AS BIGINT) AS sec,
        CAST(epoch(date_trunc('day', o_orderdate)) AS BIGINT) AS read_sec FROM orders"""
)
def date_functions(t: Tables) -> DataFrame:
    us_date = F.date_format("o_orderdate", "MM-dd-yyyy")
    return t.orders.select(
        "o_orderkey",
        F.to_date("o_orderdate").alias("day"),
        F.year("o_orderdate").alias("yr"),
        F.month("o_orderdate").alias("mnth"),
        F.quarter("o_orderdate").alias("qtr"),
        us_date.alias("us_date"),
        F.unix_timestamp("o_orderdate").alias("sec"),
        F.try_to_timestamp(us_date, F.lit("MM-dd-yyyy")).cast("bigint").alias("read_sec"),
    )


@query("SELECT CAST(event_id AS VARCHAR) AS key, props AS value, 'events' AS topic FROM events")
def kafka_envelope_decode(t: Tables) -> DataFrame:
    """Events as binary messages and back to text."""
    sent = messages.to_envelope(
        t.events, F.col("event_id").cast("string"), F.col("props"), "events", F.col("event_id"), F.col("ts")
    )
    return messages.text_of(sent, "topic")
