"""Sessions of runs that span many slices, against brute force."""

import random
from bisect import bisect_left

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillwork.operators import sessions


def starts(at, cap):
    """Session starts of one run by stepping from each to the next."""
    out, here = [], 0
    while here < len(at):
        out.append(at[here])
        here = bisect_left(at, at[here] + cap)
    return out


@pytest.mark.parametrize("cap", [1, 2, 7, 40, 1000, 10**6])
@pytest.mark.parametrize("fan", [2, 3])
def test_composed_maps_are_the_walk(cap, fan):
    draw = random.Random(cap * fan)
    for _ in range(60):
        at = sorted(draw.sample(range(3000), draw.randrange(2, 200)))
        run_start = at[0] - cap
        cuts = sorted({0, len(at), *(draw.randrange(len(at)) for _ in range(draw.randrange(1, 9)))})
        parts = [np.array(at[a:b]) for a, b in zip(cuts, cuts[1:])]
        maps = [sessions.slice_map(p, cap) for p in parts]
        assert all(len(e) <= cap + 1 for e, _ in maps)
        state, want = run_start, starts(at, cap)
        for part, one in zip(parts, maps):
            state = sessions.after_map(state, one, cap)
            assert state == max([s for s in want if s <= part[-1]], default=run_start)
        while len(maps) > 1:
            maps = [sessions.composed_map(maps[i : i + fan], cap) for i in range(0, len(maps), fan)]
        assert sessions.after_map(run_start, maps[0], cap) == want[-1]


def numbers(df):
    return dict(df.select("id", F.substring_index("session_id", "--", -1).cast("bigint")).collect())


def test_one_run_over_many_slices(spark):
    """One user, one run: 200,000 events without a gap, in eight slices and one slice each of three levels."""
    n, cap = 200_000, 7200
    draw = random.Random(1)
    at = np.cumsum([draw.choice([1, 1, 2, 30]) for _ in range(n)])
    df = spark.createDataFrame([(i, int(s)) for i, s in enumerate(at)], "id int, s bigint")
    df = df.select("id", F.lit("u").alias("user"), F.timestamp_seconds("s").cast("timestamp_ntz").alias("ts")).repartition(5)
    want = np.searchsorted(np.array(starts(at.tolist(), cap)), at, side="right")
    for group_rows, fan in ((30_000, 64), (10_000, 3)):
        got = numbers(sessions.sessionize(df, "user", "ts", "id", 60, cap, group_rows, fan))
        assert [got[i] for i in range(n)] == want.tolist()


@pytest.mark.parametrize("cap", [3, 50, 400])
def test_runs_of_several_hot_users(spark, cap):
    """Users, one of them null, with runs that end inside and at the edges of slices, and slices shorter than a session."""
    draw, data = random.Random(cap), []
    for user in ("a", "b", None):
        s = 0
        for _ in range(500):
            s += draw.choice([1, 1, 1, 5, 5, 9, 0, 100] if draw.random() < 0.1 else [1, 2, 3])
            data.append((len(data), user, s))
    want, before = {}, {}
    for i, user, s in data:
        last, start, number = before.get(user, (None, None, 0))
        if last is None or s == last or s - last >= 60 or s - start >= cap:
            start, number = s, number + 1
        before[user] = s, start, number
        want[i] = number
    df = spark.createDataFrame(data, "id int, user string, s bigint")
    df = df.withColumn("ts", F.timestamp_seconds("s").cast("timestamp_ntz")).drop("s").repartition(4)
    for group_rows, fan in ((40, 2), (150, 64), (10**9, 2)):
        assert numbers(sessions.sessionize(df, "user", "ts", "id", 60, cap, group_rows, fan)) == want
