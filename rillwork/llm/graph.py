"""Connected components of a large graph by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import saved, scratch


def _smallest(pairs: DataFrame, key: str, value: str) -> DataFrame:
    """The smallest ``value`` per ``key``, written out: a join with it can then split a hot key."""
    return saved(pairs.groupBy(key).agg(F.min(value).alias("least")), "least")


def _state(pairs: DataFrame) -> tuple:
    return tuple(
        pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(id, component)`` for every id with an edge to another; component is the smallest id.

    Each round links the neighbours of an id to its smallest neighbour, first the
    larger ones, then the smaller ones; the number of rounds grows with the
    logarithm of the longest path.  A hub only takes part through a minimum with
    map-side combination and joins whose hot side Spark can split.  Null ids and
    loops are left out; an empty graph gives an empty table.
    """
    pairs = saved(
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
        .distinct(),
        "edges",
    )
    before = _state(pairs)
    while before[0]:
        with scratch(edges.sparkSession):
            both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
                pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
            )
            least = _smallest(both, "u", "v")
            # Larger neighbours of u go to the smallest id among u and its neighbours.
            large = (
                pairs.join(least, pairs.lo == least.u)
                .select("hi", F.least("u", "least").alias("lo"))
                .distinct()
            )
            large = saved(large, "large")
            least = _smallest(large, "hi", "lo")
            joined = large.join(least.withColumnRenamed("hi", "u"), F.col("hi") == F.col("u"))
            small = (
                joined.filter(F.col("lo") != F.col("least"))
                .select(F.col("lo").alias("hi"), F.col("least").alias("lo"))
                .unionAll(least.select("hi", F.col("least").alias("lo")))
                .distinct()
            )
            pairs = saved(small, "edges", outlives=True)
        after = _state(pairs)
        if after == before:
            break
        before = after
    return pairs.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionAll(
        pairs.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )
