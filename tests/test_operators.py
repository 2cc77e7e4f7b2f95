"""Small examples with results worked out by hand, or properties that must hold."""

import pytest
from pyspark.sql import functions as F

from rillwork.functions.money import as_amount, discounted, total
from rillwork.functions.text import api_name, blank_lines, words
from rillwork.operators import aggregates, joins, logs, ordering, reshape, sets, timeseries

PRICES = [
    (101, 1, 53.0), (101, 2, 15.0), (101, 3, 57.0), (101, 4, 71.0), (101, 5, 86.0), (101, 6, 83.0),
    (102, 1, 87.0), (102, 2, 13.0),
]


def prices(spark, rows=PRICES):
    return spark.createDataFrame(rows, "stock int, at int, price double")


def test_moving_average_drops_short_windows(spark):
    got = timeseries.moving_average(prices(spark), "stock", ["at"], "price", 3)
    assert [tuple(r) for r in got.collect()] == [
        (101, 3, 57.0, 41.67), (101, 4, 71.0, 47.67), (101, 5, 86.0, 71.33), (101, 6, 83.0, 80.0),
    ]


def test_moving_average_skips_unreadable_values(spark):
    text = [(s, a, "null" if (s, a) == (101, 2) else str(p)) for s, a, p in PRICES]
    df = timeseries.readable(spark.createDataFrame(text, "stock int, at int, price string"), "price")
    got = timeseries.moving_average(df, "stock", ["at"], "price", 3)
    assert [tuple(r) for r in got.collect()] == [
        (101, 4, 71.0, 60.33), (101, 5, 86.0, 71.33), (101, 6, 83.0, 80.0),
    ]


def test_moving_average_with_info_for_one_key(spark):
    info = spark.createDataFrame([(101, "StockA", "small")], "id int, name string, category string")
    averages = timeseries.moving_average(prices(spark).filter("stock = 101"), "stock", ["at"], "price", 3)
    got = timeseries.moving_average_with(averages, info, "stock", "id", ["name", "category"])
    assert got.columns == ["stock", "at", "price", "moving_average", "name", "category"]
    assert got.count() == 4


def test_moving_average_is_sorted_without_a_second_shuffle(spark):
    plan = timeseries.moving_average(prices(spark), "stock", ["at"], "price", 3)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1


def test_moving_average_size_is_checked(spark):
    with pytest.raises(ValueError):
        timeseries.moving_average(prices(spark), "stock", ["at"], "price", 0)


SPEND = [
    ("Alice", "2016-05-01", 50.0), ("Alice", "2016-05-03", 45.0), ("Alice", "2016-05-04", 55.0),
    ("Bob", "2016-05-01", 25.0), ("Bob", "2016-05-04", 29.0), ("Bob", "2016-05-06", 27.0),
]


def test_windows_on_spending(spark, rows):
    df = spark.createDataFrame(SPEND, "name string, date string, amount double")
    lagged = timeseries.lag_lead(df, ["name"], ["date"], "amount", 2)
    assert [tuple(r) for r in lagged.select("previous", "ahead").orderBy("name", "date").collect()] == [
        (None, 55.0), (None, None), (50.0, None), (None, 27.0), (None, None), (25.0, None),
    ]
    centred = timeseries.centred_average(df, ["name"], ["date"], "amount").orderBy("name", "date")
    assert [r.centred_average for r in centred.collect()] == [47.5, 50.0, 50.0, 27.0, 27.0, 28.0]
    summed = timeseries.cumulative_sum(df, ["name"], ["date"], "amount").orderBy("name", "date")
    assert [r.cumulative_sum for r in summed.collect()] == [50.0, 95.0, 150.0, 25.0, 54.0, 81.0]


PERSONS = [
    ("James", ["Java", "Scala"], {"hair": "black", "eye": "brown"}),
    ("Michael", ["Spark", "Java", None], {"hair": "brown", "eye": None}),
    ("Robert", ["CSharp", ""], {"hair": "red", "eye": ""}),
    ("Washington", None, None),
    ("Jefferson", [], {}),
]


def persons(spark):
    return spark.createDataFrame(PERSONS, "name string, langs array<string>, features map<string,string>")


def test_explode_array(spark):
    df = persons(spark)
    assert reshape.explode_array(df, ["name"], "langs", "lang").count() == 7
    outer = reshape.explode_array(df, ["name"], "langs", "lang", outer=True)
    assert outer.count() == 9
    assert outer.filter("lang is null").count() == 3
    placed = reshape.explode_array(df, ["name"], "langs", "lang", outer=True, position=True)
    assert {tuple(r) for r in placed.filter("name = 'Michael'").collect()} == {
        ("Michael", 0, "Spark"), ("Michael", 1, "Java"), ("Michael", 2, None),
    }
    assert [tuple(r) for r in placed.filter("name = 'Jefferson'").collect()] == [("Jefferson", None, None)]


def test_explode_map(spark):
    df = persons(spark)
    assert reshape.explode_map(df, ["name"], "features").count() == 6
    assert reshape.explode_map(df, ["name"], "features", outer=True).count() == 8
    placed = reshape.explode_map(df, ["name"], "features", outer=True, position=True)
    assert placed.columns == ["name", "pos", "key", "value"]


SALES = [
    ("Banana", 1000, "USA"), ("Carrots", 1500, "USA"), ("Beans", 1600, "USA"), ("Orange", 2000, "USA"),
    ("Orange", 2000, "USA"), ("Banana", 400, "China"), ("Carrots", 1200, "China"), ("Beans", 1500, "China"),
    ("Orange", 4000, "China"), ("Banana", 2000, "Canada"), ("Carrots", 2000, "Canada"), ("Beans", 2000, "Mexico"),
]


def sales(spark):
    return spark.createDataFrame(SALES, "product string, amount int, country string")


def test_pivot_and_back(spark, rows):
    df = sales(spark)
    turned = reshape.pivot_total(df, "product", "country", "amount")
    assert rows(turned) == [
        ("Banana", 2000.0, 400.0, None, 1000.0), ("Beans", None, 1500.0, 2000.0, 1600.0),
        ("Carrots", 2000.0, 1200.0, None, 1500.0), ("Orange", None, 4000.0, None, 4000.0),
    ]
    labels = {"Canada": "canada", "China": "China", "Mexico": "Mexico", "USA": "USA"}
    back = reshape.unpivot(turned, "product", labels, "country", "total")
    sums = aggregates.sum_by(df, ["product", "country"], "amount")
    sums = sums.replace("Canada", "canada", "country")
    assert rows(back) == rows(sums)
    assert back.filter("country = 'canada'").count() == 2


def test_pivot_of_an_absent_value(spark, rows):
    turned = reshape.pivot_total(sales(spark), "product", "country", "amount", ["USA", "India"])
    assert rows(turned) == [("Banana", 1000.0, None), ("Beans", 1600.0, None), ("Carrots", 1500.0, None), ("Orange", 4000.0, None)]


def pairs(spark):
    a = spark.createDataFrame([("key1", 1), ("key2", 2), ("key1", 3), (None, 9)], "k string, v int")
    b = spark.createDataFrame([("key1", 5), ("key2", 4), ("key3", 6), (None, 8)], "k string, w int")
    return a, b


@pytest.mark.parametrize(
    "ours,how",
    [(joins.inner, "inner"), (joins.left_outer, "left"), (joins.right_outer, "right"), (joins.full_outer, "full")],
)
def test_pair_joins_equal_plain_joins(spark, rows, ours, how):
    a, b = pairs(spark)
    assert rows(ours(a, b, "k").select("k", "v", "w")) == rows(a.join(b, "k", how).select("k", "v", "w"))


def test_cogroup(spark, rows):
    a, b = (d.filter("k is not null") for d in pairs(spark))
    assert rows(joins.cogroup(a, b, "k", "v", "w")) == [
        ("key1", 0, [1, 3], [5]), ("key2", 0, [2], [4]), ("key3", 0, [], [6]),
    ]


def test_long_lists_go_on_in_chunks(spark):
    df = spark.createDataFrame([("a", i) for i in range(25)] + [("b", 1)], "k string, v int")
    for group_rows in (6, 10**9):
        lists = {(r.k, r.chunk): r.vs for r in joins.value_lists(df, "k", "v", "vs", 10, group_rows).collect()}
        assert lists == {("a", 0): list(range(10)), ("a", 1): list(range(10, 20)), ("a", 2): list(range(20, 25)), ("b", 0): [1]}


def test_dimension_is_broadcast_only_when_small(spark):
    fact = spark.range(100).withColumnRenamed("id", "k")
    dim = spark.range(50).withColumn("name", F.lit("x")).withColumnRenamed("id", "k")

    assert joins.with_dimension(fact, dim, "k").count() == 50
    assert "strategy=broadcast" not in joins.with_dimension(fact, dim, "k")._jdf.queryExecution().optimizedPlan().toString()


def test_set_operations(spark, rows):
    a = spark.createDataFrame([("lion",), ("tiger",), ("tiger",), ("peacock",), ("horse",), ("horse",), (None,)], "x string")
    b = spark.createDataFrame([("lion",), ("tiger",), ("giraffe",)], "x string")
    assert sets.union_all([a, b]).count() == 10
    assert sets.union_distinct([a, b]).count() == 6
    assert rows(sets.common(a, b)) == [("lion",), ("tiger",)]
    assert rows(sets.minus_all_copies(a, b)) == [("horse",), ("horse",), ("peacock",), (None,)]
    assert rows(sets.minus_all_copies(a, a.filter("x is null"))) == rows(a.filter("x is not null"))


def test_fold_starts_from_the_zero_record(spark, rows):
    df = spark.createDataFrame([("IT", "Jack", 1000.0), ("IT", "Bob", 2000.0), ("HR", "Bob", 2500.0), ("HR", "Carl", 7000.0), ("XX", "Al", -1.0)], "dept string, name string, pay double")
    assert rows(aggregates.fold_highest(df, "name", "pay", ["dept"])) == [("HR", "Carl", 7000.0), ("IT", "Bob", 2000.0), ("XX", "none", 0.0)]
    assert rows(aggregates.fold_highest(df, "name", "pay")) == [("Carl", 7000.0)]
    assert rows(aggregates.fold_highest(df.filter("pay < 0"), "name", "pay")) == [("none", 0.0)]
    assert rows(aggregates.fold_highest(df.limit(0), "name", "pay")) == [("none", 0.0)]


def test_means_and_totals(spark, rows):
    marks = [("maths", 50.0), ("maths", 60.0), ("english", 65.0), ("english", 65.0), ("english", 63.0), ("english", 64.0)]
    df = spark.createDataFrame(marks, "subject string, mark double")
    assert rows(aggregates.mean_by(df, ["subject"], "mark")) == [("english", 64.25), ("maths", 55.0)]
    assert rows(aggregates.sum_and_count(df, "mark")) == [(367.0, 6)]
    assert ("english", 65.0, 2) in rows(aggregates.count_by(df, ["subject", "mark"]))
    filled = aggregates.fill_with_mean(spark.createDataFrame([(1.0,), (None,), (2.0,)], "x double"), "x")
    assert rows(filled) == [(1.0,), (1.5,), (2.0,)]


def test_share_of_nothing(spark):
    empty = spark.createDataFrame([], "api string")
    assert aggregates.share_of_total(empty, ["api"], "api").count() == 0


def test_money_is_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 30 + [(-0.05,)], "x double")
    assert df.agg(as_amount(total("x"))).first()[0] == 2.95
    assert spark.createDataFrame([(400.0,)], "x double").select(discounted("x", 25)).first()[0] == 300.0


def test_top_values_keeps_ties(spark, rows):
    df = spark.createDataFrame([("a", 9, 1), ("a", 9, 2), ("a", 8, 3), ("a", 7, 4), ("a", None, 5), ("b", 1, 6)], "k string, v int, id int")
    ranked = ordering.top_values(df, ["k"], "v", 2, dense=False)
    assert rows(ranked.select("id", "rank")) == [(1, 1), (2, 1), (6, 1)]
    dense = ordering.top_values(df, ["k"], "v", 2, dense=True)
    assert rows(dense.select("id", "rank")) == [(1, 1), (2, 1), (3, 2), (6, 1)]
    shuffled = ordering.top_values(df, ["k"], "v", 2, dense=True, max_rows=2)
    assert rows(shuffled) == rows(dense)
    last = ordering.top_values(df, ["k"], "v", 5, dense=False)
    assert (5, 5) in rows(last.select("id", "rank"))


def test_sorted_within_keeps_each_group_in_order(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 2000).alias("v"))
    seen = {}
    for r in ordering.sorted_within(df, "g", ["v"]).collect():
        seen.setdefault(r.g, []).append(r.v)
    assert all(v == sorted(v) for v in seen.values()) and sum(map(len, seen.values())) == 2000


def test_samples(spark):
    df = spark.range(50).withColumnRenamed("id", "k")
    once = [r.k for r in ordering.sample_exact(df, "k", 20, 3).collect()]
    assert len(once) == len(set(once)) == 20
    assert [r.k for r in ordering.sample_exact(df, "k", 20, 3).collect()] == once
    assert ordering.sample_exact(df, "k", 99, 3).count() == 50
    assert ordering.sample_exact(df, "k", 0, 3).count() == 0
    assert ordering.sample_exact(df.limit(0), "k", 5, 3).count() == 0
    assert ordering.sample_with_replacement(df.limit(0), "k", 5, 3).count() == 0
    for seed in range(5):
        many = [r.k for r in ordering.sample_with_replacement(df, "k", 200, seed).collect()]
        assert len(many) == 200 and set(many) <= set(range(50)) and len(set(many)) > 30


def test_a_sample_has_the_smallest_hashes(spark):
    """Repeated ids share a hash, so the last digits hold more rows than are still wanted."""
    df = spark.range(3000).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    order = [F.md5(F.concat_ws("-", F.col("k").cast("string"), F.lit("9"))), F.col("k")]
    for n in (1, 75, 1000, 2999):
        expected = sorted(r.k for r in df.orderBy(*order).limit(n).collect())
        assert sorted(r.k for r in ordering.sample_exact(df, "k", n, 9).collect()) == expected


def test_words_and_lines(spark):
    df = spark.createDataFrame([("a  b\n\nb c ",), ("",)], "t string")
    assert [r[0] for r in df.select(words("t")).collect()] == [["a", "b", "b", "c"], []]
    assert [r[0] for r in df.select(blank_lines("t")).collect()] == [1, 1]


def test_word_counts_by_partition_add_up(spark, rows):
    df = spark.createDataFrame([(i, "x y " + "z " * (i % 3)) for i in range(20)], "id long, t string")
    parts = aggregates.word_counts_by_partition(df, F.col("id"), 3, words("t"))
    assert {r.part for r in parts.select("part").distinct().collect()} == {0, 1, 2}
    summed = parts.groupBy("word").agg(F.sum("n").alias("n"))
    assert rows(summed) == rows(aggregates.word_counts(df, words("t")))


LINE = "2015-05-13T23:39:43Z lb 1.1.1.1:2817 10.0.0.1:80 0.1 0.2 0.3 200 200 0 29 GET http://api.shop.example.com/v1 HTTP/1.1 curl/7 (linux)"


def test_balancer_log(spark):
    lines = spark.createDataFrame([(LINE,), ("too short a line",), (LINE.rsplit(" ", 2)[0],)], "value string")
    log = logs.balancer_log(lines)
    assert log.count() == 1
    row = log.first()
    assert (row.link, row.browser, row.time) == ("http://api.shop.example.com/v1", "curl/7", "2015-05-13T23:39:43Z")
    assert log.select(api_name("link")).first()[0] == "api.shop.example"
    assert logs.api_share(log).collect()[0].percentage == 100.0


def test_combined_log(spark, rows):
    good = "10.0.0.7 - - [10/Oct/2000:13:55:36 -0700] GET /a.gif HTTP/1.0 200 2326 http://x agent more"
    eleven = " ".join(good.split(" ")[:11])
    bad = good.replace("10.0.0.7", "localhost")
    log = logs.combined_log(spark.createDataFrame([(good,), (good,), (eleven,), (bad,)], "value string"))
    assert log.count() == 3
    assert log.filter("agent is null").count() == 1
    assert rows(logs.distinct_clients(log)) == [("10.0.0.7",)]


def test_envelope(spark, rows):
    text = '{"recordsTotal": 2, "data": [{"name": "a", "id": "x"}, {"name": "b", "id": "y"}]}'
    df = spark.createDataFrame([(1, text), (2, '{"recordsTotal": 0, "data": []}'), (3, "{bad")], "id int, doc string")
    flat = reshape.flatten_envelope(df.withColumnRenamed("id", "page"), ["page"], "doc", "name string, id string")
    assert rows(flat) == [(1, 2, 1, "a", "x"), (1, 2, 2, "b", "y")]
    assert rows(joins.listed(flat, "ordinal", [2, 7])) == [(1, 2, 2, "b", "y")]
