"""Top-k, sampling, partition-wise order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from rillwork.operators.ordered import lookup, number_rows
from rillwork.session import cut_lineage

#: Distinct ranked values up to which they are sent to every executor.
BROADCAST_ROWS = 250_000
#: Rows after which a task brings its highest values up to date.
MERGED_ROWS = 100_000
#: Hexadecimal digits of a hash by which a sample counts rows.
DIGITS = 4
#: Hexadecimal digits of the bound on the hash.
BOUND_DIGITS = 12


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in an order; every task keeps at most ``k``."""
    return df.orderBy(*order).limit(k)


def top_values(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    k: int,
    dense: bool,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows ranked at most ``k`` by descending value within their keys.

    Each task keeps the ``k`` highest distinct values of every key with their
    counts, and those alone are shuffled: at most tasks * keys * k rows, however many
    values there are and however often one comes.  A value among a key's first ``k``
    is so in every task that has it, so its count is whole.  The values that remain
    are written and counted; unless they are too many, they go to where the rows
    are, and the rows are not shuffled at all.  Null ranks last, NaN first.
    """
    highest = _highest_values(df.select(*keys, value), keys, value, k)
    counts = highest.groupBy(*keys, value).agg(F.sum("_n").alias("_n"))
    falling = Window.partitionBy(*keys).orderBy(F.col(value).desc())
    best = counts.withColumn("_dense", F.row_number().over(falling)).filter(F.col("_dense") <= k)
    if dense:
        best = best.withColumnRenamed("_dense", "rank")
    else:
        higher = F.sum("_n").over(falling.rowsBetween(Window.unboundedPreceding, -1))
        best = best.withColumn("rank", F.coalesce(higher, F.lit(0)) + 1).filter(F.col("rank") <= k)
    best = cut_lineage(best.select(*keys, value, F.col("rank").cast("bigint").alias("rank")))
    return lookup(df, best, [*keys, value], "inner", to_all=best.count() <= max_rows)


def _highest_values(df: DataFrame, keys: Sequence[str], value: str, k: int) -> DataFrame:
    """Per task, the ``k`` highest distinct values of each key, and how often they came: ``_n``."""
    schema = StructType([*df.schema.fields, StructField("_n", LongType())])
    names = [*keys, value]
    floating = df.schema[value].dataType.typeName() in ("float", "double")
    # Plain names, because keys may have the names that grouping gives its columns.
    plain = [f"c{i}" for i in range(len(names))]
    order = [*[(c, "ascending") for c in plain[:-1]], ("odd", "descending"), (plain[-1], "descending")]

    def combined(rows: pa.Table) -> pa.Table:
        sums = rows.group_by(plain).aggregate([("n", "sum")]).rename_columns([*plain, "n"])
        odd = pc.fill_null(pc.is_nan(sums[plain[-1]]), False) if floating else pa.nulls(len(sums), pa.bool_())
        sums = sums.append_column("odd", odd).sort_by(order)
        # The place of a row among those of its key: nulls sort last, so they are lowest, and equal keys are together.
        starts = np.zeros(len(sums), dtype=bool)
        starts[:1] = True
        for c in plain[:-1]:
            codes = sums[c].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
            starts[1:] |= codes[1:] != codes[:-1]
        at = np.arange(len(sums))
        place = at - np.maximum.accumulate(np.where(starts, at, 0))
        return sums.filter(pa.array(place < k)).select([*plain, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        waiting: list[pa.Table] = []
        for batch in batches:
            rows = pa.table([*batch.columns, pa.array(np.ones(batch.num_rows, dtype=np.int64))], names=[*plain, "n"])
            waiting.append(rows)
            if sum(map(len, waiting)) >= max(MERGED_ROWS, len(held) if held else 0):
                held, waiting = combined(pa.concat_tables([*([held] if held else []), *waiting])), []
        if waiting:
            held = combined(pa.concat_tables([*([held] if held else []), *waiting]))
        if held is not None:
            yield from held.rename_columns([*names, "_n"]).to_batches(max_chunksize=10_000)

    if floating:
        # Grouping here tells 0.0 and -0.0 apart, and Spark does not.
        df = df.withColumn(value, F.col(value) + F.lit(0.0).cast(df.schema[value].dataType))
    return df.select(*names).mapInArrow(run, StructType([*[schema[n] for n in names], schema["_n"]]))


def sorted_within(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows of a group next to each other and in order.

    Partitions are ranges of (group, order): a large group spans several of them
    in order instead of filling one.
    """
    return df.repartitionByRange(group, *order).sortWithinPartitions(group, *order)


def _draw(identity: Column, seed: int) -> Column:
    return F.md5(F.concat_ws("-", identity.cast("string"), F.lit(str(seed))))


def sample_exact(df: DataFrame, identity: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows without replacement, the same ones for the same seed.

    They are the rows whose hashes are smallest.  With the number of rows known, which
    files tell without being read, a bound on the hash leaves a few more than ``n``
    rows with all but certainty; they are written in the one pass over ``df``, and
    the exact cut is made among them.  If they should be too few, all rows are cut.
    The rows kept are counted by the first digits of the hash, and only those with the
    digits of the n-th row are put in order.  Nothing gathers n rows.  Calling it runs
    jobs.
    """
    rows = df.count()
    if rows <= n:
        return df
    drawn = df.withColumn("_draw", _draw(F.col(identity), seed))
    # Ten deviations: too few rows come about once in 10 ** 23 samples.
    share = min(1.0, (n + 10 * sqrt(n) + 100) / rows)
    if share < 1:
        bound = format(int(share * 16**BOUND_DIGITS), f"0{BOUND_DIGITS}x")
        likely = cut_lineage(drawn.filter(F.col("_draw") < bound))
        drawn = likely if likely.count() >= n else drawn
    digits = F.substring("_draw", 1, DIGITS)
    counts = drawn.groupBy(digits.alias("_digits")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per value of the digits, 65,536 at most.
    upto = counts.withColumn("_upto", F.sum("_n").over(Window.orderBy("_digits"))).filter(F.col("_upto") >= n)
    last = upto.orderBy("_digits").select("_digits", (F.lit(n) - F.col("_upto") + F.col("_n")).alias("_open")).first()
    edge = number_rows(drawn.filter(digits == last["_digits"]), ["_draw", identity], "_turn")
    edge = edge.filter(F.col("_turn") <= last["_open"]).select(*drawn.columns)
    return drawn.filter(digits < last["_digits"]).unionAll(edge).drop("_draw")


def sample_with_replacement(df: DataFrame, identity: str, n: int, seed: int) -> DataFrame:
    """Exactly ``n`` rows with replacement, the same ones for the same seed.

    ``n`` places are drawn among all rows, by hashes of their own.  Places drawn
    equally often are alike, so the distinct places, in order, take the rows of a
    sample without replacement, in its random order, and each row comes as often as
    its place.  An empty table gives an empty sample.  Calling it runs jobs.
    """
    size = df.agg(F.count(F.lit(1)).alias("size")).scalar()
    draws = df.sparkSession.range(n).withColumn(
        "_place",
        F.conv(F.substring(_draw(F.concat(F.lit("place-"), F.col("id")), seed), 1, 15), 16, 10).cast("bigint")
        % F.nullif(size, F.lit(0)),
    )
    times = draws.filter(F.col("_place").isNotNull()).groupBy("_place").agg(F.count(F.lit(1)).alias("_times"))
    times = number_rows(times.withColumnRenamed("_place", "_at"), ["_at"], "_turn").drop("_at")
    chosen = sample_exact(df, identity, n, seed).withColumn("_draw", _draw(F.col(identity), seed))
    chosen = number_rows(chosen, ["_draw", identity], "_turn").drop("_draw")
    copies = F.explode(F.array_repeat(F.lit(1), F.col("_times").cast("int")))
    return chosen.join(times, "_turn").withColumn("_copy", copies).drop("_turn", "_times", "_copy")
