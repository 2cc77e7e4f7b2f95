"""Click sessions with a limit on idle time and one on total length.

A user's events in time order form a *run* as long as each comes more than 0 and
less than ``idle`` seconds after the one before; two events in the same second
therefore belong to different runs.  Every run starts a session.  Within a run a
new session starts at the first event ``cap`` seconds or more after the start of
the current one.

Gaps and runs are windows.  Only events ``cap`` seconds or more into their run
can start a session inside it; they alone are walked in time order, with one
number of state per run.  A run has at most one event per second.

A run of a hot user can span many slices.  Then each slice is a *jump map*: for an
event at which the first session of the slice may start, the start of its last
one.  Whatever came before, that first start lies within ``cap`` seconds after the
slice's first event, or is the next event after them, so a map has at most
``cap + 1`` rows.  Maps of neighbouring slices are composed in a tree, the way down
the tree tells each slice in which session it begins, and the slices are walked
side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillwork.functions.times import seconds
from rillwork.operators.ordered import (
    SLICE,
    cut,
    lookup,
    near_plain,
    near_sliced,
    running_plain,
    running_sliced,
    split_hot,
)
from rillwork.session import cut_lineage


#: Maps that are composed at once: a task holds so many times ``cap + 1`` rows.
FAN = 64


def _starts_in_runs(late: DataFrame, user: str, cap: int) -> DataFrame:
    """Of the events ``cap`` seconds or more into their run, those that start a session.

    ``_state`` is the start of the session that is open when a run, or a slice of
    one, begins.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            at, state, place = (np.asarray(batch.column(c)) for c in ("_sec", "_state", "_place"))
            begins = np.flatnonzero(place == 1)
            bounds = [*([0] if not len(begins) or begins[0] else []), *begins.tolist(), batch.num_rows]
            chosen = []
            for first, last in zip(bounds, bounds[1:]):
                if place[first] == 1:
                    start = state[first]
                here = first + int(np.searchsorted(at[first:last], start + cap))
                while here < last:
                    chosen.append(here)
                    start = at[here]
                    here += int(np.searchsorted(at[here:last], start + cap))
            yield batch.take(pa.array(chosen, pa.int64()))

    # The window sorts the rows of each run, or slice of one, together and numbers
    # them, so the walk sees where they begin without looking at a user's id.
    parts = [c for c in (user, "_run_start", SLICE) if c in late.columns]
    numbered = late.withColumn("_place", F.row_number().over(Window.partitionBy(*parts).orderBy("_sec")).cast("bigint"))
    return numbered.mapInArrow(walk, numbered.schema).drop("_place", "_state")


def _near_entries(entries: np.ndarray, cap: int) -> int:
    """How many of the sorted events can be the first start: those within ``cap`` seconds, and the next one."""
    return min(len(entries), int(np.searchsorted(entries, entries[0] + cap)) + 1)


def slice_map(at: np.ndarray, cap: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a slice of sorted seconds may be entered, and the last start on the way from there."""
    last = len(at)
    ahead = np.append(np.searchsorted(at, at + cap), last)
    exits = np.append(np.arange(last), last)
    # Every round follows twice as many jumps.
    while (ahead[:-1] < last).any():
        exits = np.where(ahead < last, exits[ahead], exits)
        ahead = ahead[ahead]
    n = _near_entries(at, cap)
    return at[:n], at[exits[:n]]


def composed_map(maps: Sequence[tuple[np.ndarray, np.ndarray]], cap: int) -> tuple[np.ndarray, np.ndarray]:
    """The map of neighbouring slices, in time order, as one."""
    entries, exits = np.empty(0, np.int64), np.empty(0, np.int64)
    for own_entries, own_exits in maps:
        here = np.searchsorted(own_entries, exits + cap)
        jumps = here < len(own_entries)
        exits[jumps] = own_exits[here[jumps]]
        entries, exits = np.append(entries, own_entries), np.append(exits, own_exits)
    n = _near_entries(entries, cap)
    return entries[:n], exits[:n]


def after_map(state: int, one: tuple[np.ndarray, np.ndarray], cap: int) -> int:
    """The start of the open session after a slice, from the one before it."""
    here = int(np.searchsorted(one[0], state + cap))
    return int(one[1][here]) if here < len(one[0]) else state


def _maps_of(table: pa.Table) -> list[tuple[int, tuple[np.ndarray, np.ndarray]]]:
    """Numbers and maps in a table of one map per row, in order."""
    numbers = table.column("number").to_pylist()
    lists = zip(table.column("entries").to_pylist(), table.column("exits").to_pylist())
    return sorted(
        ((i, (np.array(a, np.int64), np.array(b, np.int64))) for i, (a, b) in zip(numbers, lists)), key=lambda v: v[0]
    )


def _open_sessions(late: DataFrame, user: str, cap: int, fan: int) -> DataFrame | None:
    """For slices of runs that span several: the session that is open when the slice begins, as ``_state``.

    None if no run spans two slices.  A slice's edge lies in one run at most, so
    such runs have less than twice as many parts as there are slices.
    """
    parts = late.groupBy(user, "_run_start", SLICE).agg(F.min("_sec").alias("_first"))
    of_run = Window.partitionBy(user, "_run_start")
    parts = parts.withColumn("_parts", F.count(F.lit(1)).over(of_run)).filter(F.col("_parts") > 1)
    # Runs have numbers here, so that a user's id is not looked at in Python.
    parts = parts.withColumns(
        {
            "_run": F.dense_rank().over(Window.orderBy(F.col(user).asc_nulls_first(), "_run_start")).cast("bigint"),
            "number": F.row_number().over(of_run.orderBy("_first")).cast("bigint") - 1,
        }
    )
    parts = cut_lineage(parts.select(user, "_run_start", SLICE, "_run", "number", "_parts"))
    most = parts.agg(F.max("_parts")).first()[0]
    if most is None:
        return None

    def first_maps(group: pa.Table) -> pa.Table:
        entries, exits = slice_map(np.sort(np.asarray(group.column("_sec"))), cap)
        return _map_row(group, group.column("number")[0].as_py(), (entries, exits))

    def _map_row(group: pa.Table, number: int, one: tuple[np.ndarray, np.ndarray]) -> pa.Table:
        columns = {n: [group.column(n)[0].as_py()] for n in ("_run", "_run_start")}
        return pa.table(
            {**columns, "number": pa.array([number], pa.int64()), "entries": [one[0]], "exits": [one[1]]}
        )

    def wider_maps(group: pa.Table) -> pa.Table:
        maps = _maps_of(group)
        return _map_row(group, maps[0][0] // fan, composed_map([m for _, m in maps], cap))

    def states(maps: pa.Table, above: pa.Table) -> pa.Table:
        """The state at each map's begin, from the state at the begin of the maps composed from them."""
        state = above.column("state")[0].as_py()
        made = []
        for number, one in _maps_of(maps):
            made.append((maps.column("_run")[0].as_py(), number, state))
            state = after_map(state, one, cap)
        return pa.table(dict(zip(("_run", "number", "state"), (pa.array(c, pa.int64()) for c in zip(*made)))))

    spread = lookup(late.select(user, "_run_start", SLICE, "_sec"), parts, [user, "_run_start", SLICE], "inner", to_all=True)
    schema = "_run bigint, _run_start bigint, number bigint, entries array<bigint>, exits array<bigint>"
    levels = [cut_lineage(spread.groupBy("_run", "number").applyInArrow(first_maps, schema))]
    while most > fan:
        group = F.floor(F.col("number") / fan)
        levels.append(cut_lineage(levels[-1].groupBy("_run", group.alias("_group")).applyInArrow(wider_maps, schema)))
        most = -(-most // fan)
    # The first session of a run starts with it.
    known = levels[-1].select("_run", F.lit(0).cast("bigint").alias("number"), F.col("_run_start").alias("state")).distinct()
    for maps in reversed(levels):
        grouped = maps.withColumn("_group", F.floor(F.col("number") / fan)).groupBy("_run", "_group")
        above = known.withColumnRenamed("number", "_group").groupBy("_run", "_group")
        known = cut_lineage(grouped.cogroup(above).applyInArrow(states, "_run bigint, number bigint, state bigint"))
    found = parts.join(known, ["_run", "number"])
    return found.select(user, "_run_start", SLICE, F.col("state").alias("_state"))


def sessionize(
    df: DataFrame,
    user: str,
    ts: str,
    tie_break: str,
    idle: int = 60 * 60,
    cap: int = 2 * 60 * 60,
    group_rows: int | None = None,
    fan: int = FAN,
) -> DataFrame:
    """Add ``session_id``, the user and the session's number from 1.

    Ids may be of any type; a null user is a user whose sessions have numbers alone.
    """
    keys, order = [user], [ts, tie_break]

    def gaps(rows, window):
        return rows.withColumn("_gap", F.col("_sec") - F.lag("_sec").over(window))

    def numbered(rows, near, running):
        rows = near(rows.withColumn("_sec", seconds(ts)))
        starts_run = F.col("_gap").isNull() | (F.col("_gap") >= idle) | (F.col("_gap") == 0)
        rows = rows.withColumn("_starts", starts_run.cast("bigint"))
        rows = running(
            rows, order, {}, {"_run_start": F.when(F.col("_starts") == 1, F.col("_sec"))}
        )
        # A start inside a run is counted by an extra row just before its event.  That
        # event is the first of its second, as any other would begin a run.
        late = rows.filter(F.col("_sec") - F.col("_run_start") >= cap)
        needed = [c for c in (user, "_sec", "_run_start", SLICE) if c in rows.columns]
        late = late.select(*needed)
        begun = F.col("_run_start").alias("_state")
        if SLICE in needed:
            late = cut_lineage(late)
            opened = _open_sessions(late, user, cap, fan)
            if opened is not None:
                late = lookup(late, opened, [user, "_run_start", SLICE], to_all=True)
                begun = F.coalesce("_state", "_run_start").alias("_state")
        marks = _starts_in_runs(late.select(*needed, begun), user, cap)
        marks = marks.withColumns({"_starts": F.lit(1).cast("bigint"), "_event": F.lit(0)})
        both = rows.withColumn("_event", F.lit(1)).unionByName(marks, allowMissingColumns=True)
        counted = running(both, ["_sec", "_event", *order], {"_number": F.col("_starts")}, {})
        shown = F.coalesce(F.col(user).cast("string"), F.lit(""))
        named = F.concat(shown, F.lit("--"), F.col("_number").cast("string"))
        return counted.filter(F.col("_event") == 1).select(*df.columns, named.alias("session_id"))

    part = split_hot(df, keys, group_rows)
    plain = numbered(
        part.rest,
        lambda rows: near_plain(rows, keys, order, gaps),
        lambda rows, by, sums, maxes: running_plain(rows, keys, by, sums, maxes),
    )
    if part.hot is None:
        return plain
    sliced = cut(part, keys, order)
    return plain.unionByName(
        numbered(
            sliced,
            lambda rows: near_sliced(rows, keys, order, 1, gaps),
            lambda rows, by, sums, maxes: running_sliced(rows, keys, by, sums, maxes),
        )
    )


def sessions_per_day(sessions: DataFrame, ts: str) -> DataFrame:
    day = F.to_date(ts).alias("day")
    return sessions.groupBy(day).agg(F.countDistinct("session_id").alias("sessions"))


def time_spent(dwelled: DataFrame, user: str, period: str) -> DataFrame:
    """Minutes per user and period from rows with ``dwell_seconds``."""
    minutes = F.sum("dwell_seconds").cast("double") / 60
    return dwelled.groupBy(user, period).agg(minutes.alias("minutes"))
