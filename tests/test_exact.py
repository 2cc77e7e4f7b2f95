"""Exact sums of doubles against Python's correctly rounded ones."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from rillwork.functions import exact
from rillwork.operators import aggregates, timeseries


def draws(kind, n, seed=9):
    rnd = random.Random(seed)
    make = {
        "money": lambda: round(rnd.uniform(-100, 100), 2),
        "wide": lambda: math.ldexp(rnd.uniform(-1, 1), rnd.randrange(-900, 900)),
        "cancel": lambda: rnd.choice([1e17, -1e17, 1.5, 0.1, 2.0**-60]),
        "tiny": lambda: rnd.choice([5e-324, -5e-324, 1e-310, 0.0, -0.0]),
        "huge": lambda: rnd.choice([1.7e308, -1.7e308, 1.0]),
        "zeros": lambda: 0.0,
    }[kind]
    return [make() for _ in range(n)]


def nearest(values):
    whole = sum(map(Fraction, values), Fraction(0))
    try:
        return float(whole)
    except OverflowError:
        return math.inf if whole > 0 else -math.inf


@pytest.mark.parametrize("kind", ["money", "wide", "cancel", "tiny", "huge", "zeros"])
def test_sum_is_the_nearest_double(spark, kind):
    data = [(i % 40, v) for i, v in enumerate(draws(kind, 1200))] + [(99, None), (100, None), (100, 0.1)]
    for parts in (1, 5):
        df = spark.createDataFrame(data, "k int, v double").repartition(parts)
        got = {r.k: r.total for r in aggregates.sum_by(df, ["k"], "v").collect()}
        for k in {k for k, _ in data}:
            values = [v for key, v in data if key == k and v is not None]
            assert got[k] == (nearest(values) if values else None), k


def test_values_that_are_not_finite(spark):
    inf, nan = math.inf, math.nan
    data = [(1, 1.0), (1, inf), (2, inf), (2, -inf), (3, nan), (3, 1.0), (4, 0.1), (4, 0.2), (5, None)]
    got = {r.k: r.total for r in aggregates.sum_by(spark.createDataFrame(data, "k int, v double"), ["k"], "v").collect()}
    assert got[1] == inf and math.isnan(got[2]) and math.isnan(got[3]) and got[4] == nearest([0.1, 0.2]) and got[5] is None


def test_half_way_totals_are_rounded_to_even(spark):
    data = [(1, 2.0**53), (1, 1.0), (2, 2.0**53), (2, 1.0), (2, 2.0**-70), (3, -(2.0**53)), (3, -1.0), (3, -(2.0**-200))]
    got = {r.k: r.total for r in aggregates.sum_by(spark.createDataFrame(data, "k int, v double"), ["k"], "v").collect()}
    assert got == {1: 2.0**53, 2: 2.0**53 + 2, 3: -(2.0**53) - 2}


def test_limbs_of_many_rows_do_not_overflow(spark):
    scale = exact.Scale(10, 4, False)
    full = [F.lit((1 << 62) + 5), F.lit(-(1 << 62)), F.lit((1 << 62) + 1), F.lit(-3)]
    value = sum(Fraction(v) * Fraction(2) ** (10 - 24 * (i + 1)) for i, v in enumerate([(1 << 62) + 5, -(1 << 62), (1 << 62) + 1, -3]))
    assert spark.range(1).select(exact.rounded(full, scale).alias("v")).first().v == float(value)


@pytest.mark.parametrize("kind", ["money", "wide"])
def test_running_and_framed_sums(spark, kind):
    values = draws(kind, 240)
    data = [(1 if i % 3 else i % 7, i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "k int, id int, v double")
    want, framed, so_far = {}, {}, {}
    for k, i, v in data:
        so_far.setdefault(k, []).append((i, v))
        want[i] = nearest([x for _, x in so_far[k]])
    for rows in so_far.values():
        for at, (i, _) in enumerate(rows):
            framed[i] = nearest([x for _, x in rows[max(0, at - 1) : at + 2]])
    for group_rows in (9, 10**9):
        got = timeseries.cumulative_sum(df.repartition(4), ["k"], ["id"], "v", group_rows)
        assert got.columns == ["k", "id", "v", "cumulative_sum"]
        assert {r.id: r.cumulative_sum for r in got.collect()} == want
        got = timeseries.centred_average(df, ["k"], ["id"], "v", group_rows)
        assert {r.id: r.frame_total for r in got.collect()} == framed


def test_means_and_fills(spark):
    df = spark.createDataFrame([(1, 0.1), (1, 0.2), (1, 0.3), (2, None)], "k int, v double")
    mean = nearest([0.1, 0.2, 0.3]) / 3
    assert {r.k: r["mean"] for r in aggregates.mean_by(df, ["k"], "v").collect()} == {1: mean, 2: None}
    assert aggregates.fill_with_mean(df, "v").filter("k = 2").first().v == mean
    assert tuple(aggregates.sum_and_count(df, "v").first()) == (nearest([0.1, 0.2, 0.3]), 3)
    assert tuple(aggregates.sum_and_count(df.filter("k = 7"), "v").first()) == (None, 0)
