"""Keyed joins, aggregates, set operations, top-k and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions.money import discounted
from rillwork.functions.text import blank_lines, words
from rillwork.operators import aggregates, joins, ordering, sets
from rillwork.plans.registry import Tables, money, query

# --- joins -----------------------------------------------------------------


@query(
    """SELECT c_custkey, c_name, o_orderkey, o_totalprice
    FROM customer JOIN orders ON o_custkey = c_custkey"""
)
def payment_join(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice")
    return joins.inner(orders, t.customer.select("c_custkey", "c_name"), "c_custkey")


PAIRS_SQL = """SELECT coalesce(o.k, u.k) AS k, o_orderkey, n_events
    FROM (SELECT o_custkey AS k, o_orderkey FROM orders) o {} JOIN
    (SELECT user_id * 11 AS k, count(*) AS n_events FROM events GROUP BY 1) u ON o.k = u.k"""

#: Users have the first numbers only; spread out, each side has keys that the other lacks.
SPREAD = 11


def _pairs(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Orders of every customer and number of events of every user."""
    orders = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey")
    users = t.events.groupBy((F.col("user_id") * SPREAD).alias("k")).agg(F.count(F.lit(1)).alias("n_events"))
    return orders, users


@query(PAIRS_SQL.format("INNER"))
def pair_join_inner(t: Tables) -> DataFrame:
    return joins.inner(*_pairs(t), "k")


@query(PAIRS_SQL.format("LEFT"))
def pair_join_left(t: Tables) -> DataFrame:
    return joins.left_outer(*_pairs(t), "k")


@query(PAIRS_SQL.format("RIGHT"))
def pair_join_right(t: Tables) -> DataFrame:
    return joins.right_outer(*_pairs(t), "k")


@query(PAIRS_SQL.format("FULL"))
def pair_join_full(t: Tables) -> DataFrame:
    return joins.full_outer(*_pairs(t), "k")


LIST_ROWS = 1000


def _text(values: str):
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",").alias(values)


def _lists_sql(key: str, value: str, name: str, source: str) -> str:
    return f"""SELECT {key} AS k, chunk, string_agg({value}, ',' ORDER BY {value}) AS {name} FROM (
        SELECT {key}, {value}, (row_number() OVER (PARTITION BY {key} ORDER BY {value}) - 1) // {LIST_ROWS} AS chunk
        FROM {source}) GROUP BY 1, 2"""


@query(
    f"""SELECT k, chunk, coalesce(left_values, '') AS left_values, coalesce(right_values, '') AS right_values
    FROM ({_lists_sql("o_custkey", "o_orderkey", "left_values", "orders")})
    FULL JOIN ({_lists_sql("user_id", "event_id", "right_values", "events")}) USING (k, chunk)"""
)
def cogroup(t: Tables) -> DataFrame:
    """Orders and events of each customer."""
    grouped = joins.cogroup(
        t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey"),
        t.events.select(F.col("user_id").alias("k"), "event_id"),
        "k",
        "o_orderkey",
        "event_id",
        LIST_ROWS,
    )
    return grouped.select("k", "chunk", _text("left_values"), _text("right_values"))


@query(
    """SELECT n_name, count(*) AS lines FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
    JOIN nation ON n_nationkey = s_nationkey GROUP BY 1"""
)
def broadcast_lookup(t: Tables) -> DataFrame:
    """Lines per nation, counted per supplier before the lookups."""
    per_supplier = t.lineitem.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"))
    places = joins.with_dimension(t.supplier, t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    named = joins.with_dimension(
        per_supplier, places.select("s_suppkey", "n_name"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return named.groupBy("n_name").agg(F.sum("lines").alias("lines"))


# --- aggregates --------------------------------------------------------------


@query(f"SELECT event_type, {money('value')} / count(value) AS mean FROM events GROUP BY 1")
def avg_by_key(t: Tables) -> DataFrame:
    return aggregates.mean_by(t.events, ["event_type"], "value", places=2)


@query("SELECT event_type, user_id, count(*) AS n FROM events GROUP BY 1, 2")
def count_by_value(t: Tables) -> DataFrame:
    return aggregates.count_by(t.events, ["event_type", "user_id"])


@query(
    """SELECT user_id, value FROM (SELECT user_id, value,
        row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""
)
def last_value_per_key(t: Tables) -> DataFrame:
    return aggregates.last_by(t.events, ["user_id"], ["ts", "event_id"], "value")


@query("SELECT event_id, value FROM events WHERE event_type = 'purchase'")
def lookup_key(t: Tables) -> DataFrame:
    return t.events.filter(F.col("event_type") == "purchase").select("event_id", "value")


@query(f"SELECT {money('l_quantity')} AS total FROM lineitem")
def reduce_sum(t: Tables) -> DataFrame:
    return aggregates.sum_by(t.lineitem, [], "l_quantity", places=2)


HIGHEST_SQL = """CASE WHEN max(c_acctbal) > 0 THEN arg_max(c_name, (c_acctbal, c_name)) ELSE 'none' END AS c_name,
    CASE WHEN max(c_acctbal) > 0 THEN max(c_acctbal) ELSE 0 END AS c_acctbal FROM customer"""


@query("SELECT " + HIGHEST_SQL)
def fold_max(t: Tables) -> DataFrame:
    return aggregates.fold_highest(t.customer, "c_name", "c_acctbal")


@query(f"SELECT c_mktsegment, {HIGHEST_SQL} GROUP BY 1")
def fold_max_by_key(t: Tables) -> DataFrame:
    return aggregates.fold_highest(t.customer, "c_name", "c_acctbal", ["c_mktsegment"])


@query(f"SELECT {money('c_acctbal')} AS total, count(c_acctbal) AS n FROM customer")
def aggregate_sum_count(t: Tables) -> DataFrame:
    return aggregates.sum_and_count(t.customer, "c_acctbal", places=2)


@query(f"SELECT c_mktsegment, {money('c_acctbal')} AS total FROM customer GROUP BY 1")
def aggregate_by_key(t: Tables) -> DataFrame:
    return aggregates.sum_by(t.customer, ["c_mktsegment"], "c_acctbal", places=2)


@query(_lists_sql("s_nationkey", "s_suppkey", '"values"', "supplier"))
def group_values(t: Tables) -> DataFrame:
    suppliers = t.supplier.select(F.col("s_nationkey").alias("k"), "s_suppkey")
    lists = joins.value_lists(suppliers, "k", "s_suppkey", "values", LIST_ROWS)
    return lists.select("k", "chunk", _text("values"))


@query(
    """SELECT CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS parity, count(p_size) AS n,
        CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY 1"""
)
def group_even_odd(t: Tables) -> DataFrame:
    return aggregates.parity_totals(t.part, "p_size")


@query(f"SELECT l_returnflag, {money('l_quantity')} AS total FROM lineitem GROUP BY 1")
def sum_by_key(t: Tables) -> DataFrame:
    return aggregates.sum_by(t.lineitem, ["l_returnflag"], "l_quantity", places=2)


@query(
    f"""SELECT l_returnflag, l_linestatus, {money('l_extendedprice')} AS total FROM lineitem
    GROUP BY 1, 2 ORDER BY 1, 2"""
)
def sum_two_keys(t: Tables) -> DataFrame:
    keys = ["l_returnflag", "l_linestatus"]
    return aggregates.sum_by(t.lineitem, keys, "l_extendedprice", places=2).orderBy(*keys)


WORDS_SQL = "(SELECT doc_id, unnest(regexp_split_to_array(text, '[ \n]')) AS word FROM documents) WHERE word <> ''"


@query(f"SELECT word, count(*) AS n FROM {WORDS_SQL} GROUP BY 1")
def word_count(t: Tables) -> DataFrame:
    return aggregates.word_counts(t.documents, words("text"))


PARTS = 64


@query(f"SELECT CAST(doc_id % {PARTS} AS INTEGER) AS part, word, count(*) AS n FROM {WORDS_SQL} GROUP BY 1, 2")
def word_count_by_partition(t: Tables) -> DataFrame:
    """Words per part of the documents."""
    documents = t.documents.select("doc_id", "text")
    return aggregates.word_counts_by_partition(documents, F.col("doc_id"), PARTS, words("text"))


@query(
    """SELECT lang, CAST(sum(len(list_filter(string_split(concat(text, chr(10), chr(10), source), chr(10)),
        lambda x: x = ''))) AS BIGINT) AS blank_lines FROM documents GROUP BY 1"""
)
def blank_line_count(t: Tables) -> DataFrame:
    """Empty lines per language of each text followed by an empty line and its source."""
    text = F.concat("text", F.lit("\n\n"), "source")
    return t.documents.groupBy("lang").agg(F.sum(blank_lines(text)).alias("blank_lines"))


# --- rows --------------------------------------------------------------------


@query("SELECT upper(c_name) AS name, c_custkey FROM customer")
def upper_map(t: Tables) -> DataFrame:
    return t.customer.select(F.upper("c_name").alias("name"), "c_custkey")


@query(
    """SELECT o_orderkey, o_totalprice,
        CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.95 AS DECIMAL(9,4)) AS DOUBLE) AS discount_amount
    FROM orders"""
)
def discount_amount(t: Tables) -> DataFrame:
    amount = discounted("o_totalprice", 5).alias("discount_amount")
    return t.orders.select("o_orderkey", "o_totalprice", amount)


# --- sets --------------------------------------------------------------------


def _buyers(t: Tables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("custkey"))


def _users(t: Tables) -> DataFrame:
    return t.events.select((F.col("user_id") * SPREAD).alias("custkey"))


BUYERS = "SELECT o_custkey AS custkey FROM orders"
USERS = f"SELECT user_id * {SPREAD} AS custkey FROM events"


@query("SELECT DISTINCT o_orderpriority, o_orderstatus FROM orders")
def distinct_values(t: Tables) -> DataFrame:
    return t.orders.select("o_orderpriority", "o_orderstatus").distinct()


@query(f"{BUYERS} UNION ALL {USERS}")
def union_all(t: Tables) -> DataFrame:
    return sets.union_all([_buyers(t), _users(t)])


@query(f"{BUYERS} INTERSECT {USERS}")
def intersect_values(t: Tables) -> DataFrame:
    return sets.common(_buyers(t), _users(t))


@query(f"SELECT custkey FROM ({BUYERS}) WHERE custkey NOT IN ({USERS})")
def subtract_keep_duplicates(t: Tables) -> DataFrame:
    return sets.minus_all_copies(_buyers(t), _users(t))


# --- top-k and samples --------------------------------------------------------


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_k(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return ordering.top_k(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey")], 10)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10")
def top_k_custom(t: Tables) -> DataFrame:
    """Top under a reversed ordering."""
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return ordering.top_k(orders, [(-F.col("o_totalprice")).desc(), F.col("o_orderkey")], 10)


SAMPLE, SEED = 100, 7
DRAW_SQL = "md5(concat({}, '-" + str(SEED) + "'))"
CHOSEN_SQL = f"""SELECT o_orderkey, o_totalprice FROM orders
    ORDER BY {DRAW_SQL.format('o_orderkey')}, o_orderkey LIMIT {SAMPLE}"""


@query(CHOSEN_SQL)
def sample_without_replacement(t: Tables) -> DataFrame:
    return ordering.sample_exact(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", SAMPLE, SEED)


@query(
    f"""WITH times AS (SELECT row_number() OVER (ORDER BY place) AS turn, times FROM (
        SELECT CAST('0x' || substr({DRAW_SQL.format("'place-', i")}, 1, 15) AS BIGINT) % (SELECT count(*) FROM orders) AS place,
            count(*) AS times FROM range({SAMPLE}) r(i) GROUP BY 1)),
    chosen AS (SELECT *, row_number() OVER (ORDER BY {DRAW_SQL.format('o_orderkey')}, o_orderkey) AS turn
        FROM ({CHOSEN_SQL}))
    SELECT o_orderkey, o_totalprice FROM (
        SELECT o_orderkey, o_totalprice, unnest(range(times)) FROM chosen JOIN times USING (turn))"""
)
def sample_with_replacement(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return ordering.sample_with_replacement(orders, "o_orderkey", SAMPLE, SEED)
