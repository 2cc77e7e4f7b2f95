"""Ordered work per key: neighbouring rows, running totals, ranks, row numbers.

A window puts all rows of one key into one task.  That is right for ordinary
keys and wrong for a key that holds a third of the table, so every function here
treats the two apart:

* keys of up to ``group_rows`` rows use the plain window;
* the rows of larger keys are range-partitioned by (key, order) into slices,
  written to the shared folder once, worked on slice by slice, and corrected at
  the cuts with a few rows or one total per slice.

Both parts are exact and their union is the result.  Whether a table has such a
key is found out first: a table smaller than ``group_rows`` needs only its row
count, a larger one a count per key with map-side combination.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillwork.session import cut_lineage

#: Rows of one key that a single task may sort, unless the session sets another limit.
GROUP_ROWS = 5_000_000
GROUP_ROWS_CONF = "spark.rillwork.groupRows"
#: Rows of keys or key totals up to which they are sent to every executor; more are joined.
BROADCAST_KEYS = 100_000

SLICE = "_slice"

Compute = Callable[[DataFrame, WindowSpec], DataFrame]


def lookup(
    df: DataFrame, small: DataFrame, names: Sequence[str], how: str = "left", to_all: bool = False
) -> DataFrame:
    """Join on null-safe equality of ``names``, keeping the columns of ``df`` once."""
    renamed = small.withColumnsRenamed({n: f"_key_{n}" for n in names})
    equal = [F.col(n).eqNullSafe(F.col(f"_key_{n}")) for n in names]
    joined = df.join(
        F.broadcast(renamed) if to_all else renamed, reduce(lambda a, b: a & b, equal), how
    )
    return joined.drop(*[f"_key_{n}" for n in names])


def dealt(df: DataFrame, parts: Column, name: str) -> DataFrame:
    """Add ``name``, a number from 0 to ``parts`` - 1 that rows get in turn.

    Rows that have a choice are put in the order of their whole contents first, so
    a task that is run again, with its rows in another order, deals them alike and
    none is lost or doubled on the way to its part.  Only rows that are the same in
    every column may change places.
    """

    def comparable(field: T.StructField) -> Column:
        cell, kind = F.col(f"`{field.name}`"), field.dataType.simpleString()
        return F.to_json(F.struct(cell)) if "map<" in kind or "variant" in kind else cell

    row = F.struct(*[comparable(f).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    choice = parts > 1
    ordered = df.sortWithinPartitions(F.when(choice, F.xxhash64(row)), F.when(choice, row))
    return ordered.withColumn(name, F.pmod(F.monotonically_increasing_id(), parts).cast("int"))


class Split(NamedTuple):
    """The rows of ordinary keys and, where there are any, of hot keys."""

    rest: DataFrame
    hot: DataFrame | None = None
    hot_rows: int = 0
    n_slices: int = 0


def group_limit(spark: SparkSession, group_rows: int | None = None) -> int:
    """Rows of one key for a single task: the given number, the session's, or the usual one."""
    return int(spark.conf.get(GROUP_ROWS_CONF, str(GROUP_ROWS))) if group_rows is None else group_rows


def split_hot(df: DataFrame, keys: Sequence[str], group_rows: int | None = None) -> Split:
    """Part the rows of keys with more than ``group_rows`` rows from all others."""
    group_rows = group_limit(df.sparkSession, group_rows)
    if df.count() <= group_rows:
        return Split(df)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    found = cut_lineage(sizes.filter(F.col("_rows") > group_rows))
    n_keys, n_rows = found.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    if n_keys == 0:
        return Split(df)
    hot_keys = found.select(*keys)
    few = n_keys <= BROADCAST_KEYS
    return Split(
        lookup(df, hot_keys, keys, "left_anti", to_all=few),
        lookup(df, hot_keys, keys, "left_semi", to_all=few),
        n_rows,
        ceil(n_rows / group_rows) + 1,
    )


def slices(hot: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """Cut the rows, ordered by key and order, into ``n`` numbered slices of even size."""
    placed = hot.repartitionByRange(max(n, 2), *keys, *order).withColumn(
        SLICE, F.spark_partition_id()
    )
    return cut_lineage(placed)


def cut(part: Split, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return slices(part.hot, keys, order, part.n_slices)


def near_plain(df: DataFrame, keys: Sequence[str], order: Sequence[str], compute: Compute) -> DataFrame:
    return compute(df, Window.partitionBy(*keys).orderBy(*order))


def near_sliced(
    sliced: DataFrame, keys: Sequence[str], order: Sequence[str], reach: int, compute: Compute
) -> DataFrame:
    """``near_plain`` for sliced rows.

    A row further than ``reach`` from both ends of its slice has its whole frame
    inside the slice.  The others have it among the rows within ``2 * reach`` of
    an end, which are few enough for a window over the whole key.
    """
    inside = Window.partitionBy(*keys, SLICE)
    ordered = inside.orderBy(*order)
    placed = sliced.withColumn("_from", F.row_number().over(ordered)).withColumn(
        "_near", F.least("_from", F.count(F.lit(1)).over(inside) - F.col("_from") + 1)
    )
    middle = compute(placed, ordered).filter(F.col("_near") > reach)
    ends = compute(
        placed.filter(F.col("_near") <= 2 * reach), Window.partitionBy(*keys).orderBy(*order)
    ).filter(F.col("_near") <= reach)
    return middle.unionByName(ends).drop("_from", "_near")


def near(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    reach: int,
    compute: Compute,
    group_rows: int | None = None,
) -> DataFrame:
    """Add columns that look at most ``reach`` rows back or ahead within a key.

    ``compute(df, window)`` adds them; ``order`` must be a total order per key.
    """
    part = split_hot(df, keys, group_rows)
    plain = near_plain(part.rest, keys, order, compute)
    if part.hot is None:
        return plain
    sliced = cut(part, keys, order)
    return plain.unionByName(near_sliced(sliced, keys, order, reach, compute).drop(SLICE))


def running_plain(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    maxes: Mapping[str, Column] | None = None,
) -> DataFrame:
    frame = (
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    totals = {n: F.sum(v).over(frame) for n, v in sums.items()}
    totals |= {n: F.max(v).over(frame) for n, v in (maxes or {}).items()}
    return df.withColumns(totals)


def running_sliced(
    sliced: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    maxes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``running_plain`` for sliced rows: the slice's own totals plus those before it."""
    maxes = maxes or {}
    names = [*sums, *maxes]
    own = running_plain(sliced, [*keys, SLICE], order, sums, maxes)
    per_slice = sliced.groupBy(*keys, SLICE).agg(
        *[F.sum(v).alias(f"_t_{n}") for n, v in sums.items()],
        *[F.max(v).alias(f"_t_{n}") for n, v in maxes.items()],
    )
    # One row per key and slice, so this window is as small as the number of slices.
    earlier = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = per_slice.select(
        *keys,
        SLICE,
        *[F.sum(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n in sums],
        *[F.max(f"_t_{n}").over(earlier).alias(f"_b_{n}") for n in maxes],
    )
    # Slices are ranges, so hot keys and slices meet in at most 2 * rows / group_rows + 1 pairs.
    joined = lookup(own, before, [*keys, SLICE], to_all=True)
    whole = {
        n: F.when(F.col(n).isNull(), F.col(f"_b_{n}")).otherwise(
            F.col(n) + F.coalesce(F.col(f"_b_{n}"), F.lit(0))
        )
        for n in sums
    }
    whole |= {n: F.greatest(n, f"_b_{n}") for n in maxes}
    return joined.withColumns(whole).drop(*[f"_b_{n}" for n in names])


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column],
    maxes: Mapping[str, Column] | None = None,
    group_rows: int | None = None,
) -> DataFrame:
    """Add running sums and maxima per key, from its first row to the current one."""
    part = split_hot(df, keys, group_rows)
    plain = running_plain(part.rest, keys, order, sums, maxes)
    if part.hot is None:
        return plain
    sliced = cut(part, keys, order)
    return plain.unionByName(running_sliced(sliced, keys, order, sums, maxes).drop(SLICE))


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, group_rows: int | None = None
) -> DataFrame:
    """Number the rows of each key from 1 in the given total order."""
    one = F.lit(1).cast("bigint")
    return running(df, keys, order, {name: one}, group_rows=group_rows)


def ranks(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    tie_break: Sequence[str] = (),
    group_rows: int | None = None,
) -> DataFrame:
    """Add ``rank`` and ``dense_rank`` by ``order`` and, given a tie break, ``row_number``.

    For hot keys the ranks come from the counts per distinct order value, so
    equal rows are combined before anything is ordered.
    """
    part = split_hot(df, keys, group_rows)
    by_order = Window.partitionBy(*keys).orderBy(*order)
    added = {
        "rank": F.rank().over(by_order).cast("bigint"),
        "dense_rank": F.dense_rank().over(by_order).cast("bigint"),
    }
    if tie_break:
        total = Window.partitionBy(*keys).orderBy(*order, *tie_break)
        added["row_number"] = F.row_number().over(total).cast("bigint")
    plain = part.rest.withColumns(added)
    if part.hot is None:
        return plain

    one = F.lit(1).cast("bigint")
    hot = part.hot
    if tie_break:
        total_order = [*order, *tie_break]
        sliced = cut(part, keys, total_order)
        hot = running_sliced(sliced, keys, total_order, {"row_number": one}).drop(SLICE)
        counted = sliced.groupBy(*keys, *order)
    else:
        counted = hot.groupBy(*keys, *order)
    # Read several times below: counted, added up, and looked up per row.
    counts = cut_lineage(counted.agg(F.count(F.lit(1)).alias("_n")))
    few = counts.count() <= BROADCAST_KEYS
    counts = running(
        counts, keys, order, {"_through": F.col("_n"), "dense_rank": one}, group_rows=group_rows
    )
    rank = (F.col("_through") - F.col("_n") + 1).alias("rank")
    counts = counts.select(*keys, *order, rank, "dense_rank")
    return plain.unionByName(lookup(hot, counts, [*keys, *order], "inner", to_all=few))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Number all rows from 1 in a total order without one global window.

    Rows are range-partitioned and sorted; a row's number is its place in its
    partition plus the sizes of the partitions before.
    """
    place = F.monotonically_increasing_id()
    placed = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    )
    # monotonically_increasing_id keeps the partition above bit 33 and the place below.
    placed = placed.withColumn(SLICE, F.shiftright("_place", 33)).withColumn(
        "_place", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    )
    sizes = placed.groupBy(SLICE).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition.
    earlier = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select(SLICE, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    return (
        placed.join(F.broadcast(before), SLICE)
        .withColumn(name, F.col("_before") + F.col("_place") + 1)
        .drop(SLICE, "_place", "_before")
    )
