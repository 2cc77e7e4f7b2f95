"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets a fractional number of copies, its source's target size over
the source's size.  The whole part is taken as it is; the fraction is rounded in
pairs: two documents exchange words until the fraction of one is 0 or 1, in a
random direction whose odds keep every document's expected copies.  A pair keeps
its words, so a source's taken words move only when its very last fraction is
rounded; large documents are paired first, so that one is small.  Documents are dealt into buckets of bounded size; each bucket leaves at
most one fraction, and these go through a reduction tree, bucket by bucket, until
one is left per source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillwork.llm.common import WORD, saved, scratch

#: Weights of the sources in order, repeating, and the most copies of a document.
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Units that a task rounds one after the other, and fractions that meet in a node of the tree.
BUCKET_ROWS = 10_000
FAN_IN = 256
SEED = 17

SCHEMA = "src string, doc bigint, size bigint, bucket bigint, copies bigint, left_over double, weight double"


def word_count(text: str) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame) -> DataFrame:
    """Target size per source, from one row per source (``src``, ``total``).

    Sources in code-point order, null last, weigh 5, 2, 1, repeating, and share all
    words; a target stops at three times its source's words, and what is over goes
    to the others by weight until none is above.  That is one level for all sources
    below their limit: target = level * weight.  Sources in order of limit / weight
    are at their limit as long as the level that the rest would get is above it.
    The windows hold one row per source.
    """
    order = Window.orderBy(F.col("src").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(WEIGHTS)))
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), turn + 1).cast("double")
    weighed = sizes.withColumn("weight", weight).withColumn("cap", F.col("total") * MOST_COPIES)
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), F.col("src").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    after = by_need.rowsBetween(0, Window.unboundedFollowing)
    levels = weighed.withColumn(
        "level",
        (F.sum("total").over(Window.partitionBy()) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(after),
    )
    below = levels.withColumn("open", F.col("level") * F.col("weight") < F.col("cap"))
    level = F.min(F.when(F.col("open"), F.struct("place", "level"))).over(Window.partitionBy())["level"]
    placed = below.withColumn("place", F.row_number().over(by_need)).withColumn("level", level)
    target = F.when(
        F.col("level").isNull() | (F.col("level") * F.col("weight") >= F.col("cap")), F.col("cap").cast("double")
    ).otherwise(F.col("level") * F.col("weight"))
    return placed.select("src", F.col("total").alias("source_size"), target.alias("target"))


def draw(*parts) -> float:
    """A number in [0, 1) that depends on the parts alone."""
    return xxhash.xxh3_64_intdigest(repr(parts).encode(), seed=SEED) / 2.0**64


def pivot(p: list[float], size: list[float], names: list) -> tuple[list[float], int]:
    """Round fractions pairwise; returns them and the place of the one left over, or -1.

    Of a pair with fractions p and q and sizes s and t, either p gains a and q loses
    a * s / t, or the other way round with b, each the most that is possible; the
    odds b : a keep both expectations, and s * p + t * q does not change.
    """
    p = list(p)
    open_ = -1
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if open_ < 0:
            open_ = i
            continue
        j = open_
        s, t = size[j], size[i]
        up = min((1 - p[j]) * s, p[i] * t)
        down = min(p[j] * s, (1 - p[i]) * t)
        if draw(names[j], names[i]) * (up + down) < down:
            p[j], p[i] = p[j] + up / s, p[i] - up / t
            full = (1 - p[j]) * s <= p[i] * t
        else:
            p[j], p[i] = p[j] - down / s, p[i] + down / t
            full = p[j] * s <= (1 - p[i]) * t
        # The one that has reached an end is set to it exactly.
        done = j if full else i
        p[done] = float(round(p[done]))
        other = i if done == j else j
        if min(p[other], 1 - p[other]) < 1e-12:
            p[other] = float(round(p[other]))
            open_ = -1
        else:
            open_ = other
    return p, open_


def _leaves(table: pa.Table) -> pa.Table:
    """Round one bucket of documents; the one left over keeps its fraction in ``left_over``."""
    # Largest first, so that what is left over in the end is small.
    order = np.lexsort((np.nan_to_num(table["doc"].to_numpy(zero_copy_only=False)), np.array(table["mixed"]), -np.array(table["size"])))
    docs = table["doc"].take(pa.array(order))
    src, bucket = table["src"][0].as_py(), table["bucket"][0].as_py()
    size = np.array(table["size"])[order]
    weight = np.array(table["weight"])[order]
    share = np.array(table["share"])[order]
    whole = np.floor(share)
    names = list(zip([src] * len(order), docs.to_pylist(), size.tolist()))
    rounded, open_ = pivot((share - whole).tolist(), weight.tolist(), names)
    left = [None] * len(order)
    if open_ >= 0:
        left[open_] = rounded[open_]
        rounded[open_] = 0.0
    copies = (whole + np.array(rounded)).astype(np.int64)
    return pa.table(
        [pa.array([src] * len(order), pa.string()), docs.cast(pa.int64()), pa.array(size), pa.array([bucket] * len(order), pa.int64()), pa.array(copies), pa.array(left, pa.float64()), pa.array(weight, pa.float64())],
        names=["src", "doc", "size", "bucket", "copies", "left_over", "weight"],
    )


def _node(table: pa.Table) -> pa.Table:
    """Round the fractions that meet in one node of the tree."""
    order = np.lexsort((np.array(table["bucket"]), -np.array(table["weight"])))
    src, parent = table["src"][0].as_py(), table["parent"][0].as_py()
    buckets = np.array(table["bucket"])[order].tolist()
    weight = np.array(table["weight"])[order].tolist()
    names = [(src, "node", parent, b) for b in buckets]
    p, open_ = pivot(np.array(table["p"])[order].tolist(), weight, names)
    last = bool(table["last"][0].as_py())
    if open_ >= 0 and last:
        p[open_] = 1.0 if draw(src, "root") < p[open_] else 0.0
    return pa.table(
        [pa.array([src] * len(order), pa.string()), pa.array(buckets, pa.int64()), pa.array([parent] * len(order), pa.int64()), pa.array(p, pa.float64()), pa.array(weight, pa.float64())],
        names=["src", "bucket", "parent", "p", "weight"],
    )


def reduced(rest: DataFrame, buckets: int) -> DataFrame:
    """Whether each bucket's left-over fraction is rounded up: (src, bucket, extra).

    Level by level ``FAN_IN`` neighbours meet; a fraction that is still open keeps
    its bucket's number and goes on to the next level.
    """
    decided = []
    level, width = rest, buckets
    while True:
        width = -(-width // FAN_IN)
        step = saved(
            level.withColumn("parent", F.floor(F.col("place") / FAN_IN).cast("bigint"))
            .withColumn("last", F.lit(width <= 1))
            .groupBy("src", "parent")
            .applyInArrow(_node, "src string, bucket bigint, parent bigint, p double, weight double"),
            "node",
        )
        decided.append(step.filter("p = 0 or p = 1").select("src", "bucket", F.col("p").cast("bigint").alias("extra")))
        if width <= 1:
            break
        level = step.filter("p > 0 and p < 1").select("src", "bucket", "p", "weight", F.col("parent").alias("place"))
    out = decided[0]
    for d in decided[1:]:
        out = out.unionAll(d)
    return out


def mixed(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """How often the mix takes each document.

    Returns one row per row of ``df``: its id, ``source``, ``size`` in words,
    ``source_size``, ``target`` of its source, ``copies`` and ``taken`` = copies *
    size.  A null text has size 0, a null source is a source of its own, and rows
    with the same source, id and size are rounded together, so all have the same
    copies.  Documents without words, and all of them where nothing has words, are
    taken once.  An empty table gives an empty result; other columns are ignored.
    Calling it runs jobs.  Draws are hashes of ids, so reruns agree.
    """
    rows = saved(
        df.select(
            F.col(id).cast("bigint").alias("doc"),
            F.col(source).cast("string").alias("src"),
            word_count(text).alias("size"),
        ),
        "sizes",
    )
    totals = rows.groupBy("src").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n"))
    totals = saved(totals, "totals")
    goals = saved(
        targets(totals.select("src", "total")).join(
            totals.select(F.col("src").alias("s"), F.ceil(F.col("n") / BUCKET_ROWS).alias("buckets")),
            F.col("src").eqNullSafe(F.col("s")),
        ).drop("s"),
        "targets",
    )
    units = rows.filter("size > 0").groupBy("src", "doc", "size").agg(F.count(F.lit(1)).alias("n"))
    hashed = F.xxhash64(F.lit(SEED), "doc", "size")
    small = goals.select(F.col("src").alias("s"), "target", "source_size", "buckets")
    dealt = units.join(small, F.col("src").eqNullSafe(F.col("s"))).select(
        "src", "doc", "size",
        (F.col("n") * F.col("size")).cast("double").alias("weight"),
        F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST_COPIES))).alias("share"),
        F.pmod(hashed, F.col("buckets")).alias("bucket"),
        F.xxhash64(hashed, F.lit(1)).alias("mixed"),
    )
    leaves = saved(dealt.groupBy("src", "bucket").applyInArrow(_leaves, SCHEMA), "leaves")
    rest = leaves.filter("left_over is not null").select(
        "src", "bucket", F.col("left_over").alias("p"), "weight", F.col("bucket").alias("place")
    )
    most = goals.agg(F.max("buckets")).first()[0] or 1
    extra = saved(reduced(rest, int(most)), "extra").withColumnsRenamed({"src": "s", "bucket": "b"})
    final = leaves.join(
        extra,
        F.col("src").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")) & F.col("left_over").isNotNull(),
        "left",
    ).select(
        F.col("src").alias("fs"), F.col("doc").alias("fd"), F.col("size").alias("fz"),
        (F.col("copies") + F.coalesce("extra", F.lit(0))).alias("copies"),
    )
    named = rows.join(
        final,
        F.col("src").eqNullSafe(F.col("fs")) & F.col("doc").eqNullSafe(F.col("fd")) & (F.col("size") == F.col("fz")),
        "left",
    ).drop("fs", "fd", "fz")
    copies = F.coalesce("copies", F.lit(1)).cast("bigint")
    return named.join(small.drop("buckets"), F.col("src").eqNullSafe(F.col("s"))).select(
        F.col("doc").alias(id), F.col("src").alias("source"), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: every row of ``df`` as often as it is taken, with all its columns, whatever their names.

    Null sources, texts and ids, repeated rows and documents without words are
    treated as in ``mixed``; an empty table stays empty.  Calling it runs jobs.
    """
    with scratch(df.sparkSession):
        plan = saved(
            mixed(df, id, text, source)
            .select(F.col("source").alias("_s"), F.col(id).alias("_d"), F.col("size").alias("_z"), F.col("copies").alias("_c"))
            .filter("_c != 1")
            .distinct(),
            "plan",
            outlives=True,
        )
    # The row travels as one column, so its columns cannot clash with the operator's own.
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"),
        F.col(source).cast("string").alias("_source"),
        F.col(id).cast("bigint").alias("_id"),
        word_count(text).alias("_size"),
    )
    # The plan has a row per document, so it grows with the table and is never broadcast, however small.
    joined = rows.join(
        plan.hint("merge"),
        F.col("_source").eqNullSafe(F.col("_s")) & F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_size") == F.col("_z")),
        "left",
    )
    times = F.coalesce("_c", F.lit(1)).cast("int")
    return joined.select("_row", F.explode(F.array_repeat(F.lit(1), times))).select("_row.*")
