"""Joins, lists and top values where one key or one value holds a large part of the rows."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rillwork.operators import joins, ordered, ordering


def sides(spark, seed):
    """A key hot on the left, one on the right, one on both, null on both, and keys of one side only."""
    draw = random.Random(seed)
    left = [(draw.choice(["l"] * 6 + ["b", "b", None, None, *"pqrs"]), draw.randrange(4)) for _ in range(160)]
    right = [(draw.choice(["r"] * 6 + ["b", None, None, "l", *"pqxy"]), draw.randrange(3)) for _ in range(120)]
    left += [("only left", 1)] * 40
    right += [("only right", 2)] * 40
    return left, right, spark.createDataFrame(left, "k string, v int"), spark.createDataFrame(right, "k string, w int")


def joined(left, right, how):
    out = Counter()
    keys_left, keys_right = {k for k, _ in left if k}, {k for k, _ in right if k}
    for k, v in left:
        out.update((k, v, w) for j, w in right if k is not None and j == k)
        if how == "full" and k not in keys_right:
            out[k, v, None] += 1
    out.update((k, None, w) for k, w in right if k not in keys_left)
    return out


@pytest.mark.parametrize("how", ["right", "full"])
@pytest.mark.parametrize("group_rows", [9, 35, 10**9])
def test_outer_joins_of_hot_keys(spark, how, group_rows):
    left, right, a, b = sides(spark, group_rows)
    join = joins.right_outer if how == "right" else joins.full_outer
    got = join(a.repartition(3), b.repartition(3), "k", group_rows)
    assert got.columns == ["k", "v", "w"]
    assert Counter(map(tuple, got.collect())) == joined(left, right, how)
    assert Counter(map(tuple, join(a, b.limit(0), "k", group_rows).collect())) == joined(left, [], how)
    assert Counter(map(tuple, join(a.limit(0), b, "k", group_rows).collect())) == joined([], right, how)


@pytest.mark.parametrize("parts", [1, 3, 200])
def test_rows_are_dealt_alike_in_any_order(spark, parts):
    """As a task sees them that is run again after its input came in another order."""
    draw = random.Random(parts)
    data = [(draw.choice(["x", "y", None]), draw.randrange(9), {"m": draw.randrange(3)}, [draw.random() < 0.5]) for _ in range(600)]
    data += [("same", 0, None, None)] * 300
    ways = []
    for _ in range(3):
        draw.shuffle(data)
        df = spark.createDataFrame(data, "`a.b` string, n int, m map<string,int>, l array<boolean>").coalesce(1)
        # Rows whose n is 0 and others have different choices.
        many = F.when(F.col("n") == 0, F.lit(parts)).otherwise(F.lit(1))
        rows = ordered.dealt(df, many, "part").collect()
        ways.append(Counter(repr(tuple(r)) for r in rows))
        sizes = Counter(r.part for r in rows if r.n == 0)
        assert set(sizes) <= set(range(parts)) and max(sizes.values()) - min(sizes[i] for i in range(parts)) <= 1
        assert all(r.part == 0 for r in rows if r.n)
    assert ways[0] == ways[1] == ways[2]
    assert ordered.dealt(df.limit(0), F.lit(2), "part").count() == 0


def test_a_hot_full_join_reads_each_side_once(spark, tmp_path):
    _, _, a, b = sides(spark, 1)
    for name, df in (("a", a), ("b", b)):
        df.write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    plan = joins.full_outer(a, b, "k", 20)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [k") == 2 and plan.count("Join FullOuter") == 1


@pytest.mark.parametrize("group_rows", [7, 10**9])
def test_lists_of_repeated_values(spark, group_rows):
    draw = random.Random(3)
    data = [("hot", 5)] * 120 + [(draw.choice(["hot", "a", None]), draw.choice([1, 2, 5, 9, None])) for _ in range(90)]
    df = spark.createDataFrame(data, "k string, v int").repartition(4)
    got = {(r.k, r.chunk): r.vs for r in joins.value_lists(df, "k", "v", "vs", 10, group_rows).collect()}
    for key in ("hot", "a", None):
        values = sorted((v for k, v in data if k == key), key=lambda v: (v is not None, v or 0))
        chunks = [values[i : i + 10] for i in range(0, len(values), 10)]
        assert [got[key, i] for i in range(len(chunks))] == [[v for v in c if v is not None] for c in chunks]
    assert len(got) == sum(math.ceil(n / 10) for n in Counter(k for k, _ in data).values())


@pytest.mark.parametrize("k", [1, 2, 5, 100])
@pytest.mark.parametrize("merged", [7, 100_000])
def test_top_values_against_sorting(spark, monkeypatch, k, merged):
    monkeypatch.setattr(ordering, "MERGED_ROWS", merged)
    draw = random.Random(k)
    values = [1.5, 2.5, -0.0, 0.0, 7.0, math.nan, None, math.inf, *(float(i) for i in range(20))]
    data = [(draw.choice(["hot"] * 5 + ["a", "b", None]), draw.choice(values), i) for i in range(300)]
    data = [("hot", 7.0 if i % 3 else v, i) if key == "hot" else (key, v, i) for key, v, i in data]
    df = spark.createDataFrame(data, "n string, v double, id int").repartition(5)
    low = lambda v: (v is not None, math.inf if v is None or math.isnan(v) else v, v is not None and math.isnan(v))
    for dense in (True, False):
        want = {}
        for key in {d[0] for d in data}:
            mine = [low(d[1]) for d in data if d[0] == key]
            for d in data:
                if d[0] == key:
                    higher = [v for v in mine if v > low(d[1])]
                    rank = len(set(higher) if dense else higher) + 1
                    if rank <= k:
                        want[d[2]] = rank
        got = ordering.top_values(df, ["n"], "v", k, dense)
        assert {r.id: r["rank"] for r in got.collect()} == want


def test_only_highest_values_are_shuffled(spark):
    df = spark.range(0, 40_000, 1, 4).select((F.col("id") % 3).alias("n"), F.xxhash64("id").alias("v"))
    kept = ordering._highest_values(df, ["n"], "v", 5)
    assert kept.count() == 4 * 3 * 5
    empty = ordering.top_values(df.limit(0), ["n"], "v", 5, True)
    assert empty.count() == 0
    assert ordering.top_values(df, [], "v", 3, True).count() == 3
