"""Keyed joins of two tables.

Joins are left to Spark: it broadcasts a side only when its size is known to be
small, and splits a hot left-hand key at run time in inner and left joins.  It
cannot split one in full joins, nor the left side's in right joins; there, rows of
hot keys get salts on their side and are copied to all salts on the other.  A copy
that met nothing is no unmatched row, because a hot key has rows on its side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillwork.operators.ordered import BROADCAST_KEYS, dealt, group_limit, lookup, running
from rillwork.session import cut_lineage

#: Parts into which rows without a key are dealt.
NULL_PARTS = 200


def inner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key)


def left_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.join(right, key, "left")


def _hot_parts(df: DataFrame, key: str, name: str, group_rows: int | None) -> DataFrame | None:
    """Keys with more than ``group_rows`` rows, and into how many parts their rows are dealt; None if there are none.

    A table with fewer rows is only counted, in a larger one rows are counted per key.
    """
    limit = group_limit(df.sparkSession, group_rows)
    if df.count() <= limit:
        return None
    sizes = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    parts = F.ceil(F.col("_rows") / limit).cast("int").alias(name)
    hot = cut_lineage(sizes.filter(F.col("_rows") > limit).select(key, parts))
    return None if hot.isEmpty() else hot


def _with_parts(df: DataFrame, key: str, hot: Mapping[str, DataFrame | None]) -> DataFrame:
    """Add the number of parts of the row's key on either side, 1 for a key that is not hot there."""
    for name, keys in hot.items():
        if keys is None:
            df = df.withColumn(name, F.lit(1))
            continue
        few = keys.count() <= BROADCAST_KEYS
        df = lookup(df, keys, [key], to_all=few).withColumn(name, F.coalesce(name, F.lit(1)))
    return df


def _salted(left: DataFrame, right: DataFrame, key: str, how: str, group_rows: int | None) -> DataFrame:
    """A right or full join that reads and shuffles each side once, however hot a key is."""
    hot = {
        "_left_parts": _hot_parts(left, key, "_left_parts", group_rows),
        "_right_parts": _hot_parts(right, key, "_right_parts", group_rows) if how == "full" else None,
    }
    if not any(h is not None for h in hot.values()):
        return left.join(right, key, how)

    def side(df: DataFrame, own: str, other: str, salts: tuple[str, str], mark: str) -> DataFrame:
        df = _with_parts(df, key, hot)
        # Null keys meet nothing, so their rows may go anywhere.
        parts = F.when(F.col(key).isNull(), F.lit(NULL_PARTS)).otherwise(F.col(own))
        df = dealt(df, parts, salts[0])
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return df.withColumn(salts[1], copies).withColumn(mark, F.lit(True)).withColumnsRenamed(
            {n: f"{n}{mark}" for n in hot}
        )

    a = side(left, "_left_parts", "_right_parts", ("_a", "_b"), "_in_left")
    b = side(right, "_right_parts", "_left_parts", ("_b", "_a"), "_in_right")
    joined = a.join(b, [key, "_a", "_b"], how)
    # A row without a partner is one only if the other side has no rows of its key in any part.
    lonely_right = F.col("_in_left").isNull() & (F.col("_left_parts_in_right") > 1)
    lonely_left = F.col("_in_right").isNull() & (F.col("_right_parts_in_left") > 1)
    kept = joined.filter(~F.coalesce(lonely_right, F.lit(False)) & ~F.coalesce(lonely_left, F.lit(False)))
    return kept.select(*dict.fromkeys([*left.columns, *right.columns]))


def right_outer(left: DataFrame, right: DataFrame, key: str, group_rows: int | None = None) -> DataFrame:
    """All rows of the right side.  Calling it counts the left side's rows, and its keys if it is large."""
    return _salted(left, right, key, "right", group_rows)


def full_outer(left: DataFrame, right: DataFrame, key: str, group_rows: int | None = None) -> DataFrame:
    """All rows of both sides.  Calling it counts their rows, and the keys of large ones."""
    return _salted(left, right, key, "full", group_rows)


def without(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left rows whose key does not occur on the right."""
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")


def with_dimension(fact: DataFrame, dimension: DataFrame, on: Column | str) -> DataFrame:
    """Inner join with a dimension.

    Spark sends the dimension to every executor if its bytes, known or measured at
    run time, are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    return fact.join(dimension, on)


def value_lists(
    df: DataFrame, key: str, value: str, name: str, chunk_rows: int, group_rows: int | None = None
) -> DataFrame:
    """The sorted values of each key as lists of at most ``chunk_rows`` values.

    List 0 holds a key's first values, list 1 the next, and so on: a key of any
    size is kept whole without ever being one row.  Equal values are counted before
    anything is put in order, and a value that fills several lists is cut by its
    count.  Nulls take their places, first, and do not show.
    """
    runs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = running(runs, [key], [value], {"_upto": F.col("_n")}, group_rows=group_rows)
    first = F.col("_upto") - F.col("_n")
    size = F.lit(chunk_rows).cast("bigint")
    chunks = F.sequence(F.floor(first / size), F.floor((F.col("_upto") - 1) / size))
    cut = placed.withColumn("chunk", F.explode(chunks))
    times = F.least("_upto", (F.col("chunk") + 1) * size) - F.greatest(first, F.col("chunk") * size)
    run = F.struct(F.col(value).alias("v"), times.cast("int").alias("n"))
    lists = cut.groupBy(key, "chunk").agg(F.sort_array(F.collect_list(run)).alias("_runs"))
    shown = F.filter("_runs", lambda r: r["v"].isNotNull())
    return lists.select(key, "chunk", F.flatten(F.transform(shown, lambda r: F.array_repeat(r["v"], r["n"]))).alias(name))


def cogroup(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_value: str,
    right_value: str,
    chunk_rows: int = 10_000,
    group_rows: int | None = None,
) -> DataFrame:
    """All values of both sides per key, empty where a side has none.

    Long lists continue in further rows of the key, numbered by ``chunk``.
    """
    a = value_lists(left, key, left_value, "left_values", chunk_rows, group_rows)
    b = value_lists(right, key, right_value, "right_values", chunk_rows, group_rows)
    types = {f.name: f.dataType for f in [*a.schema, *b.schema]}
    # Both sides hold one row per key and chunk, so no key is hot here.
    return a.join(b, [key, "chunk"], "full").select(
        key,
        "chunk",
        *[
            F.coalesce(n, F.array().cast(types[n])).alias(n)
            for n in ("left_values", "right_values")
        ],
    )


def listed(df: DataFrame, column: str, values: Sequence[int]) -> DataFrame:
    """Rows whose ``column`` is in a short list given by the caller."""
    kind = df.schema[column].dataType.simpleString()
    wanted = df.sparkSession.createDataFrame([(v,) for v in values], f"_wanted {kind}")
    return df.join(F.broadcast(wanted), F.col(column) == F.col("_wanted"), "left_semi")
