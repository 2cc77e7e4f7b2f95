"""Versioned tables: deltas, compaction, replay, ranges that stay as they are, and histories of many changes."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from rillwork.operators import history
from rillwork.session import shared_path
from rillwork.sources import versions

ROWS = "k string, n bigint"


def table(spark, data):
    return spark.createDataFrame(sorted(data.items(), key=str), ROWS)


def held(df):
    return {r.k: r.n for r in df.collect()}


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/data/**/part-*", recursive=True)}


@pytest.fixture
def path(spark):
    return shared_path(spark, "versions").removeprefix("file:")


def test_upserts_replay_and_compaction(spark, path):
    draw, want, kinds = random.Random(2), {}, set()
    for version in range(7):
        changes = {draw.choice(["a", "b", "c", "d", None]) if version % 3 else f"k{draw.randrange(30)}": version * 10 + i for i in range(6)}
        changes = {} if version == 4 else changes
        want |= changes
        for _ in range(2 if version in (2, 5) else 1):
            found = versions.upsert(table(spark, changes), path, ["k"], version, buckets=3)
            assert held(versions.read(spark, path)) == want
            assert versions.read(spark, path).count() == len(want)
        kinds |= {p.kind for p in found.pieces}
        assert sum(p.rows for p in found.pieces) >= len(want)
        assert versions.versions(spark, path) == list(range(max(0, version - 1), version + 1))
    assert kinds == {versions.BASE, versions.DELTA}
    listed = {p for v in versions.versions(spark, path) for p in versions.manifest(spark, path, v + 1).pieces}
    there = {tuple(d.split("/")[-3:]) for d in glob.glob(f"{path}/data/*/*/bucket=*")}
    assert there == {(f"kind={p.kind}", f"version={p.version}", f"bucket={p.bucket}") for p in listed}


def test_bytes_follow_the_changed_keys(spark, path):
    big = {f"key {i}": i for i in range(20_000)}
    versions.upsert(table(spark, big), path, ["k"], 0, buckets=4)
    whole = size(path)
    before = files(path)
    versions.upsert(table(spark, {"key 5": -1, "new": 1}), path, ["k"], 1, buckets=4)
    assert files(path).items() >= before.items() and size(path) - whole < whole / 20
    assert held(versions.read(spark, path)) == big | {"key 5": -1, "new": 1}


def test_a_bucket_is_compacted_at_the_latest_after_so_many_deltas(spark, path):
    versions.upsert(table(spark, {str(i): i for i in range(200)}), path, ["k"], 0, buckets=1)
    for version in range(1, 7):
        found = versions.upsert(table(spark, {"7": -version}), path, ["k"], version, most_deltas=3)
        assert len(found.pieces) <= 3
    assert held(versions.read(spark, path)) == {str(i): i for i in range(200)} | {"7": -6}


def test_an_unfinished_version_does_not_count(spark, path):
    versions.upsert(table(spark, {"a": 1}), path, ["k"], 0)
    versions.upsert(table(spark, {"a": 2}), path, ["k"], 1)
    os.remove(f"{path}/manifest/version=1/_SUCCESS")
    assert held(versions.read(spark, path)) == {"a": 1}
    versions.upsert(table(spark, {"a": 3}), path, ["k"], 1)
    assert held(versions.read(spark, path)) == {"a": 3}


def test_no_version_is_an_error(spark, path):
    with pytest.raises(ValueError):
        versions.read(spark, path)


@pytest.mark.parametrize("kind", ["int", "string", "date"])
@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_rows_find_their_range(spark, path, kind, ranges):
    """Also keys that were not there, between, before and after the ranges, null, and fewer keys than ranges."""
    key = {"int": "id * 3", "string": "concat('k', id * 3)", "date": "date_add(DATE '2020-01-01', cast(id * 3 as int))"}[kind]
    df = spark.range(20).select(F.expr(f"CASE WHEN id > 0 THEN {key} END").alias("key"), "id")
    found = versions.save_ranges(df, path, "key", ranges)
    assert sum(p.rows for p in found.pieces) == 20
    rows = versions.read_pieces(spark, path, found, found.pieces).withColumn("b", versions.bucket_of(found))
    assert rows.filter("b <> _bucket").count() == 0
    more = spark.range(-3, 25).select(F.expr(key.replace("id * 3", "id * 3 + 1")).alias("key")).withColumn("b", versions.bucket_of(found))
    lows = list(found.lows)
    assert all(r.b == sum(low <= r.key for low in lows) for r in more.collect())


# --- histories -----------------------------------------------------------------

OPEN = history.OPEN_DATE


def brute(changes):
    """Rows of a history from (key, date) pairs."""
    out, keys = [], {}
    for key, date in changes:
        keys.setdefault(key, set()).add(date or history.NO_DATE)
    for key, dates in keys.items():
        days = sorted(dates)
        out += [(key, d, e, "I") for d, e in zip(days, days[1:])] + [(key, days[-1], OPEN, "A")]
    return sorted(out, key=str)


def pattern(date):
    return None if date is None else f"{date[5:7]}-{date[8:]}-{date[:4]}"


def dated(spark, changes, mark):
    return spark.createDataFrame([(k, pattern(d), mark) for k, d in changes], "k string, at string, mark string")


def some_changes(n, keys, seed):
    draw = random.Random(seed)
    return [(draw.choice(keys), draw.choice([None, *(f"20{draw.randrange(10, 30)}-0{draw.randrange(1, 10)}-1{draw.randrange(10)}" for _ in range(9))])) for _ in range(n)]


def merged(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("group_rows", [7, 10**9])
def test_many_changes_of_a_key(spark, group_rows):
    keys = ["hot"] * 30 + [f"k{i}" for i in range(12)] + [None]
    base, updates, more = some_changes(20, [*keys[30:]], 1), some_changes(120, keys, 2), some_changes(60, keys, 3)
    first = history.merge_history(dated(spark, base, "A"), dated(spark, updates, "U"), "k", "at", "mark", group_rows)
    assert merged(first) == brute(base + updates)
    assert first.filter("change_date = '9999-12-31'").groupBy("k").count().filter("count <> 1").count() == 0
    # The result is a base, and the same updates again change nothing.
    again = history.merge_history(first, dated(spark, more + updates, "U"), "k", "at", "mark", group_rows)
    assert merged(again) == brute(base + updates + more)


def test_merge_touches_only_ranges_with_changes(spark, path):
    base = [(f"k{i:04}", "2015-01-11") for i in range(400)]
    whole = history.merge_history(dated(spark, base, "A"), dated(spark, [], "U"), "k", "at", "mark")
    found = history.save_history(whole, path, "k", 8)
    assert len(found.pieces) == 8
    before = files(path)
    updates = [("k0001", "2016-01-11"), ("k0001", "2018-02-12"), ("k0001", "2017-02-12"), ("k0003", None), ("k9999", "2020-01-01")]
    for _ in range(2):
        after = history.merge_saved(spark, path, dated(spark, updates, "U"), "at", "mark", 1)
    assert files(path).items() >= before.items()
    assert {p.bucket for p in after.pieces if p.version == 1} == {0, 7}
    assert merged(versions.read(spark, path)) == brute(base + updates)
    more = [("k0200", "2021-03-03"), (None, "2021-03-03")]
    history.merge_saved(spark, path, dated(spark, more, "U"), "at", "mark", 2)
    assert merged(versions.read(spark, path)) == brute(base + updates + more)
    with pytest.raises(ValueError):
        history.merge_saved(spark, path, dated(spark, more, "U"), "at", "mark", 0)


def test_merging_nothing(spark, path):
    empty = dated(spark, [], "A")
    assert history.merge_history(empty, empty, "k", "at", "mark").count() == 0
    history.save_history(history.merge_history(empty, empty, "k", "at", "mark"), path, "k", 4)
    assert versions.read(spark, path).count() == 0
    history.merge_saved(spark, path, dated(spark, [("a", "2020-01-01")], "A"), "at", "mark", 1)
    assert merged(versions.read(spark, path)) == [("a", "2020-01-01", OPEN, "A")]
