"""Hot keys: every ordered operator must give the same rows whether keys are split or not."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillwork.operators import history, joins, ordered, sessions, timeseries

SMALL, PLAIN = 15, 10**9


@pytest.fixture(scope="module")
def events(spark):
    """300 events; user 1 has a third of them, user 2 many, and times repeat."""
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        user = 1 if i % 3 == 0 else 2 if i % 5 == 0 else rnd.randrange(3, 40)
        second = rnd.randrange(0, 120) * 1000 + rnd.randrange(3)
        rows.append((user, second, i, round(rnd.random() * 100, 2)))
    df = spark.createDataFrame(rows, "user_id int, second long, event_id int, value double")
    return df.withColumn("ts", F.timestamp_seconds("second").cast("timestamp_ntz")).drop("second").cache()


def test_split_hot_parts_all_rows(events):
    part = ordered.split_hot(events, ["user_id"], SMALL)
    assert part.hot.filter("user_id = 1").count() == events.filter("user_id = 1").count()
    assert part.hot.count() == part.hot_rows
    assert part.hot.count() + part.rest.count() == 300
    assert part.rest.groupBy("user_id").count().agg(F.max("count")).first()[0] <= SMALL


def test_no_hot_key_means_plain_window(events):
    assert ordered.split_hot(events, ["user_id"], PLAIN).hot is None
    assert ordered.split_hot(events, ["user_id"], 150).hot is None


def test_slices_follow_the_order(events):
    hot = events.filter("user_id = 1")
    cut = ordered.slices(hot, ["user_id"], ["ts", "event_id"], 5)
    bounds = cut.groupBy("_slice").agg(
        F.min(F.struct("ts", "event_id")).alias("lo"), F.max(F.struct("ts", "event_id")).alias("hi")
    ).orderBy("_slice").collect()
    assert len(bounds) > 1
    assert all(tuple(a.hi) < tuple(b.lo) for a, b in zip(bounds, bounds[1:]))


OPERATIONS = {
    "moving_average": lambda e, n: timeseries.moving_average(e, "user_id", ["ts", "event_id"], "value", 3, n),
    "moving_average_1": lambda e, n: timeseries.moving_average(e, "user_id", ["ts", "event_id"], "value", 1, n),
    "moving_average_long": lambda e, n: timeseries.moving_average(e, "user_id", ["ts", "event_id"], "value", 20, n),
    "centred": lambda e, n: timeseries.centred_average(e, ["user_id"], ["ts", "event_id"], "value", n),
    "lag_lead": lambda e, n: timeseries.lag_lead(e, ["user_id"], ["ts", "event_id"], "value", 2, n),
    "cumulative": lambda e, n: timeseries.cumulative_sum(e, ["user_id"], ["ts", "event_id"], "value", n),
    "gaps": lambda e, n: timeseries.event_gaps(e, ["user_id"], ["ts", "event_id"], n),
    "dwell": lambda e, n: timeseries.dwell(e, "user_id", ["ts", "event_id"], n),
    "ranks": lambda e, n: ordered.ranks(e, ["user_id"], ["ts"], ["event_id"], n),
    "ranks_no_tie_break": lambda e, n: ordered.ranks(e, ["user_id"], ["ts"], group_rows=n),
    "positions": lambda e, n: ordered.positions(e, ["user_id"], ["ts", "event_id"], "pos", n),
    "sessions": lambda e, n: sessions.sessionize(e, "user_id", "ts", "event_id", 3000, 7000, n),
    "sessions_long_runs": lambda e, n: sessions.sessionize(e, "user_id", "ts", "event_id", 50000, 4000, n),
    "lists": lambda e, n: joins.value_lists(e, "user_id", "event_id", "ids", 10, n),
}


@pytest.mark.parametrize("name", OPERATIONS)
def test_hot_keys_change_nothing(events, rows, name):
    run = OPERATIONS[name]
    assert rows(run(events, SMALL)) == rows(run(events, PLAIN))


def test_hot_ties_are_ranked_exactly(spark, rows):
    """A third of the rows share key and order value."""
    data = [(1, 5 if i % 3 == 0 else i % 17, i) for i in range(120)]
    df = spark.createDataFrame(data, "k int, v int, id int")
    assert rows(ordered.ranks(df, ["k"], ["v"], ["id"], 10)) == rows(ordered.ranks(df, ["k"], ["v"], ["id"], PLAIN))


def test_null_keys_are_a_key(spark, rows):
    data = [(None if i % 2 else 1, i, float(i)) for i in range(60)]
    df = spark.createDataFrame(data, "k int, id int, v double")
    small, plain = (ordered.running(df, ["k"], ["id"], {"s": F.col("v")}, {"m": F.col("v")}, n) for n in (6, PLAIN))
    assert rows(small) == rows(plain)


def test_running_over_nulls(spark, rows):
    data = [(1, i, None if i < 12 else float(i)) for i in range(40)]
    df = spark.createDataFrame(data, "k int, id int, v double")
    small, plain = (ordered.running(df, ["k"], ["id"], {"s": F.col("v")}, {"m": F.col("v")}, n) for n in (5, PLAIN))
    assert rows(small) == rows(plain)


def test_number_rows(spark, rows):
    df = spark.createDataFrame([(i * 7 % 1000, i) for i in range(1000)], "k int, v int").repartition(6)
    want = df.withColumn("row_id", F.row_number().over(Window.orderBy("k")).cast("bigint"))
    assert rows(ordered.number_rows(df, ["k"])) == rows(want.select("k", "v", "row_id"))


def brute_sessions(events, idle, cap):
    """Session numbers by stepping through each user's events."""
    out, users = {}, {}
    for user, sec, event in sorted(events):
        users.setdefault(user, []).append((sec, event))
    for user, clicks in users.items():
        number, elapsed, before = 0, 0, None
        for sec, event in clicks:
            gap = 0 if before is None or sec - before >= idle else sec - before
            if gap == 0 or elapsed + gap >= cap:
                number, elapsed = number + 1, 0
            else:
                elapsed += gap
            out[event] = f"{user}--{number}"
            before = sec
    return out


@pytest.mark.parametrize("idle,cap", [(3000, 7000), (50000, 4000), (10**6, 1000), (2, 3)])
@pytest.mark.parametrize("group_rows", [SMALL, PLAIN])
def test_sessions_against_brute_force(events, idle, cap, group_rows):
    plain = [(r.user_id, int(r.s), r.event_id) for r in events.select("user_id", "event_id", F.unix_timestamp("ts").alias("s")).collect()]
    got = sessions.sessionize(events, "user_id", "ts", "event_id", idle, cap, group_rows)
    assert {r.event_id: r.session_id for r in got.collect()} == brute_sessions(plain, idle, cap)


def test_sessions_of_the_click_example(spark):
    """Two users on two days, with limits of one and two hours, in Indian time."""
    clicks = [
        ("u1", "2018-01-01T11:00:00Z"), ("u1", "2018-01-01T11:30:00Z"), ("u1", "2018-01-01T12:00:00Z"),
        ("u2", "2018-01-01T11:00:00Z"), ("u2", "2018-01-02T11:00:00Z"), ("u2", "2018-01-02T11:15:00Z"),
        ("u2", "2018-01-02T13:25:00Z"), ("u1", "2018-01-01T12:15:00Z"), ("u1", "2018-01-01T14:15:00Z"),
    ]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        df = spark.createDataFrame([(u, t, i) for i, (u, t) in enumerate(clicks)], "user_id string, click string, id int")
        df = df.withColumn("ts", F.col("click").cast("timestamp")).drop("click")
        got = sessions.sessionize(df, "user_id", "ts", "id")
        shown = sorted((r.user_id, r.t, r.session_id) for r in got.select("user_id", F.date_format("ts", "yyyy-MM-dd HH:mm").alias("t"), "session_id").collect())
        assert shown == [
            ("u1", "2018-01-01 16:30", "u1--1"), ("u1", "2018-01-01 17:00", "u1--1"),
            ("u1", "2018-01-01 17:30", "u1--1"), ("u1", "2018-01-01 17:45", "u1--1"),
            ("u1", "2018-01-01 19:45", "u1--2"),
            ("u2", "2018-01-01 16:30", "u2--1"), ("u2", "2018-01-02 16:30", "u2--2"),
            ("u2", "2018-01-02 16:45", "u2--2"), ("u2", "2018-01-02 18:55", "u2--3"),
        ]
        days = {str(r.day): r.sessions for r in sessions.sessions_per_day(got, "ts").collect()}
        assert days == {"2018-01-01": 3, "2018-01-02": 2}
        dwelled = timeseries.dwell(df, "user_id", ["ts", "id"])
        seconds = sorted((r.user_id, r.dwell_seconds) for r in dwelled.collect())
        assert seconds == [("u1", 0), ("u1", 900), ("u1", 1800), ("u1", 1800), ("u1", 7200), ("u2", 0), ("u2", 0), ("u2", 900), ("u2", 7800)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_history_merge_example(spark, rows):
    schema = "prodid string, last string, indicator string"
    base = spark.createDataFrame([("1", None, "A"), ("2", "01-25-1981", "A"), ("3", " 01-26-1982 ", "A"), ("4", "12-20-1985", "A")], schema)
    updates = spark.createDataFrame([("2", "01-25-2018", "U"), ("4", "01-25-2018", "U"), ("6", "01-25-2018", "A"), ("8", "01-25-2018", "A")], schema)
    merged = history.merge_history(base, updates, "prodid", "last", "indicator")
    assert rows(merged) == [
        ("1", "0001-01-01", "9999-12-31", "A"),
        ("2", "1981-01-25", "2018-01-25", "I"),
        ("2", "2018-01-25", "9999-12-31", "A"),
        ("3", "1982-01-26", "9999-12-31", "A"),
        ("4", "1985-12-20", "2018-01-25", "I"),
        ("4", "2018-01-25", "9999-12-31", "A"),
        ("6", "2018-01-25", "9999-12-31", "A"),
        ("8", "2018-01-25", "9999-12-31", "A"),
    ]
    open_rows = merged.filter("change_date = '9999-12-31'").groupBy("prodid").count()
    assert open_rows.filter("count <> 1").count() == 0
