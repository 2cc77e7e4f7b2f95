"""Sharding by fixed virtual slots.

Records are hashed into 16,384 slots, and a versioned map says which shard each
slot is on.  The map is made from the bytes per slot, largest slot first onto the
lightest shard, and edited when the sizes or the number of shards change: slots
move from shards that are too heavy to those that are too light, all others stay.
The number of slots is fixed, so the map is a bounded table whatever the input.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillwork.llm.common import saved
from rillwork.operators.ordered import BROADCAST_KEYS, lookup, positions

SLOTS = 16_384
#: Bytes that a record counts besides its text.
OVERHEAD = 16
#: How far above the mean a shard may be, in hundredths, before slots move.
SLACK = 0.5
MAP = "version int, virtual_slot int, shard int, bytes bigint"


def slot_of(id: Column, crc: Column, *turn: Column) -> Column:
    """A record's slot; the text's checksum spreads records that share an id, or have none, and ``turn`` repeated ones."""
    return F.pmod(F.xxhash64(F.lit(3), id, crc, *turn), F.lit(SLOTS)).cast("int")


def records(df: DataFrame, id: str, text: str) -> DataFrame:
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b"").cast("binary"))
    sized = df.select(
        F.col(id).alias("id"), (F.octet_length(body) + OVERHEAD).cast("bigint").alias("size"), F.crc32(body).alias("crc")
    )
    return sized.withColumn("virtual_slot", slot_of(F.col("id"), F.col("crc")))


def spread(rows: DataFrame) -> DataFrame:
    """Give repeated records, after the first of each, slots by their turn.

    Repeats are alike, so it does not matter which one has which turn.  Turns of very
    many repeats are counted in slices.
    """
    rows = saved(rows.withColumn("_at", F.monotonically_increasing_id()), "records")
    same = ["id", "crc", "size"]
    many = saved(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "repeats")
    n = many.count()
    if not n:
        return rows.drop("_at")
    few = n <= BROADCAST_KEYS
    turned = positions(lookup(rows, many, same, "left_semi", to_all=few), same, ["_at"], "_turn")
    again = slot_of(F.col("id"), F.col("crc"), F.col("_turn"))
    turned = turned.withColumn("virtual_slot", F.when(F.col("_turn") > 1, again).otherwise(F.col("virtual_slot")))
    once = lookup(rows, many, same, "left_anti", to_all=few)
    return saved(once.drop("_at").unionByName(turned.drop("_at", "_turn")), "records")


def slot_bytes(rows: DataFrame) -> dict[int, int]:
    """Bytes per slot; at most ``SLOTS`` numbers reach the driver."""
    return {r.virtual_slot: r.n for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("n")).collect()}


def place(sizes: dict[int, int], shards: int) -> dict[int, int]:
    """A first map: slots by falling size, each onto the lightest shard so far."""
    load = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(SLOTS), key=lambda v: (-sizes.get(v, 0), v)):
        n, shard = heapq.heappop(load)
        out[slot] = shard
        # An empty slot counts one byte here, so that empty slots spread too.
        heapq.heappush(load, (n + max(sizes.get(slot, 0), 1), shard))
    return out


def rebalance(old: dict[int, int], sizes: dict[int, int], shards: int) -> dict[int, int]:
    """An edited map: slots leave shards that are gone or heavier than the mean allows.

    From the heaviest shards the largest slots that still fit go to the lightest
    one; a move that would not even the two out is not made.
    """
    out = dict(old)
    load = [0] * shards
    on: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in old.items():
        n = sizes.get(slot, 0)
        if shard < shards:
            load[shard] += n
            on[shard].append((n, slot))
        else:
            homeless.append((n, slot))
    for n, slot in sorted(homeless, reverse=True):
        shard = min(range(shards), key=lambda s: (load[s], s))
        out[slot] = shard
        load[shard] += n
        on[shard].append((n, slot))
    limit = sum(load) / shards * (1 + SLACK / 100)
    for _ in range(SLOTS):
        heavy = max(range(shards), key=lambda s: (load[s], -s))
        light = min(range(shards), key=lambda s: (load[s], s))
        room = (load[heavy] - load[light]) / 2
        fits = [x for x in on[heavy] if 0 < x[0] <= room]
        if load[heavy] <= limit or not fits:
            break
        n, slot = max(fits)
        on[heavy].remove((n, slot))
        on[light].append((n, slot))
        load[heavy] -= n
        load[light] += n
        out[slot] = light
    return out


def write_map(spark: SparkSession, path: str, version: int, mapping: dict[int, int], sizes: dict[int, int]) -> None:
    """Add a version of the map to the table at ``path``; earlier versions stay."""
    rows = [(version, slot, shard, sizes.get(slot, 0)) for slot, shard in sorted(mapping.items())]
    spark.createDataFrame(rows, MAP).coalesce(1).write.mode("append").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of the map, the last one unless named."""
    stored = spark.read.schema(MAP).parquet(path)
    wanted = F.lit(version) if version is not None else F.lit(stored.agg(F.max("version")).first()[0])
    return stored.filter(F.col("version") == wanted)


def shard(df: DataFrame, map_path: str, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row of ``df`` into a shard by the map at ``map_path``, made or edited here.

    Without a map there, version 1 is made; otherwise the last version is edited for
    the sizes and shards at hand and stored as the next one.  Sizes come out near
    equal (law ``bytes``).  Returns per row: its id, ``size``, ``text_crc32``,
    ``law``, ``shard``, ``slot`` (its place in the shard, without gaps from 0, by
    virtual slot and id), ``grown_shard`` (null), ``virtual_slot`` and ``version``.
    A null text has no bytes; null ids are spread by their texts' checksums, repeated
    rows by their turn; an empty table gives an empty result, other columns are
    ignored.  Sizes alone decide: equal texts of different ids are not kept together.
    Calling it runs jobs.
    """
    spark = df.sparkSession
    rows = spread(records(df, id, text))
    sizes = slot_bytes(rows)
    jvm = spark._jvm.org.apache.hadoop.fs.Path(map_path)
    there = jvm.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm)
    version = 1
    if there:
        last = read_map(spark, map_path).collect()
        version = last[0].version + 1
        mapping = rebalance({r.virtual_slot: r.shard for r in last}, sizes, shards)
    else:
        mapping = place(sizes, shards)
    write_map(spark, map_path, version, mapping, sizes)
    stored = read_map(spark, map_path, version).drop("bytes")
    # Rows before a slot in its shard: one row per slot, so the windows are small.
    counts = rows.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = saved(
        counts.join(F.broadcast(stored), "virtual_slot").withColumn(
            "before", F.coalesce(F.sum("n").over(earlier), F.lit(0))
        ),
        "offsets",
    ).drop("n")
    inside = Window.partitionBy("virtual_slot").orderBy("id", "crc", "size")
    placed = rows.withColumn("_row", F.row_number().over(inside)).join(F.broadcast(offsets), "virtual_slot")
    return placed.select(
        F.col("id").alias(id),
        "size",
        F.col("crc").cast("bigint").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("before") + F.col("_row") - 1).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "version",
    )
