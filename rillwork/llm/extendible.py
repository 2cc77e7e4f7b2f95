"""Exact deduplication over an extendible-hash index in shared files, with DataFrame functions only.

The key of a text is its 64-bit hash.  A *bucket* holds the keys that share a
prefix of bits; the *directory* maps every prefix of the deepest bucket's length
to its bucket.  It begins with one bucket; as long as a bucket holds more bytes
of different texts than ``capacity``, it is split by one more bit, and the
directory doubles when the bucket was among the deepest ones.  Splits work on
bytes per cell (a prefix of fixed length), so they read the keys once.

Each bucket is a range of keys and belongs to one owner task, which compares the
bytes of all texts that share a key: rows with equal bytes become one entry, and
different texts under one key are chained in the order of their ids.  A key with
very many rows would fill its owner however deep the directory, so its rows are
dealt over several owners, whose entries are compared once more by their bytes.
The entries are written to the shared folder by bucket.
"""

from __future__ import annotations

from math import ceil, log2
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillwork.llm.common import saved, scratch

#: Bytes of different texts that a bucket holds before it is split, in small tables.
BUCKET_BYTES = 4 << 20
#: Capacities by which a table may be full: beyond that, buckets hold more instead of becoming more.
MOST_BUCKETS = 1 << 15
#: Bits of the longest prefix: the directory has at most 2 ** MOST_BITS rows of three numbers.
MOST_BITS = 20
#: Bits below the expected depth at which bytes are counted.
SPARE_BITS = 4
#: Rows of one key that one owner compares; in large tables, a MOST_CROWDS-th of all rows.
CROWD_ROWS, MOST_CROWDS = 256, 50_000


class Index(NamedTuple):
    """``directory``: slot, bucket, depth.  ``entries``: bucket, key, chain, n_bytes, digest, keep_id, group_size.

    ``rows`` has the key and digest of every row's text, ``limit`` the rows above
    which a group counts as large; there are fewer than MOST_CROWDS such groups.
    """

    directory: DataFrame
    entries: DataFrame
    rows: DataFrame
    limit: int
    bits: int


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null as the empty text."""
    return F.coalesce(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "), F.lit(""))


def hashed(text: Column) -> Column:
    """The key of a text."""
    return F.xxhash64(text)


def slot(key: Column, bits: int) -> Column:
    """The first bits of a key as a number."""
    return F.shiftrightunsigned(key, 64 - bits)


def directory(keys: DataFrame, capacity: int, bits: int) -> DataFrame:
    """Split buckets until none holds more than ``capacity`` bytes in more than one key.

    ``keys`` has one row per key, with the bytes of its longest text.  A bucket of
    the longest prefix stays as it is.  Buckets are numbered as in a heap: a split
    of ``b`` makes ``2 * b`` and ``2 * b + 1``.
    """
    cells = keys.groupBy(slot(F.col("key"), bits).alias("slot")).agg(
        F.sum("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_keys")
    )
    cells = saved(cells.withColumns({"bucket": F.lit(1).cast("bigint"), "depth": F.lit(0)}), "index-cells")
    for depth in range(bits):
        level = cells.filter(F.col("depth") == depth).groupBy("bucket")
        held = level.agg(F.sum("n_bytes").alias("_bytes"), F.sum("n_keys").alias("_keys"))
        full = saved(held.filter((F.col("_bytes") > capacity) & (F.col("_keys") > 1)).select("bucket"), "index-full")
        if full.isEmpty():
            break
        bit = F.shiftright("slot", bits - depth - 1).bitwiseAND(F.lit(1).cast("bigint"))
        # Cells number at most 2 ** bits, and so do their buckets.
        split = cells.join(F.broadcast(full.withColumn("_full", F.lit(True))), "bucket", "left")
        cells = saved(
            split.withColumns(
                {
                    "bucket": F.when(F.col("_full"), 2 * F.col("bucket") + bit).otherwise(F.col("bucket")),
                    "depth": F.when(F.col("_full"), F.lit(depth + 1)).otherwise(F.col("depth")),
                }
            ).select(*cells.columns),
            "index-cells",
        )
    return cells.select("slot", "bucket", "depth")


def build(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_BYTES, crowd: int = CROWD_ROWS
) -> Index:
    """Index all whole texts of ``docs``; other columns are not read.  Calling it runs jobs.

    Texts are read twice: once for keys and digests, once for their owners, which
    get every text once.
    """
    shown = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text"))
    shown = shown.withColumn("key", hashed(F.col("text")))
    rows = saved(
        shown.select("id", "key", F.octet_length("text").cast("bigint").alias("n_bytes"),
                     F.unhex(F.sha2("text", 256)).alias("digest")),
        "index-rows",
    )
    keys = rows.groupBy("key").agg(F.max("n_bytes").alias("n_bytes"), F.count(F.lit(1)).alias("n_rows"))
    keys = saved(keys, "index-keys")
    total, n_rows = keys.agg(F.coalesce(F.sum("n_bytes"), F.lit(0)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
    capacity = max(capacity, total // MOST_BUCKETS)
    bits = min(MOST_BITS, SPARE_BITS + max(0, ceil(log2(max(total, 1) / capacity))))
    slots = directory(keys, capacity, bits)

    limit = max(crowd, n_rows // MOST_CROWDS)
    parts = F.ceil(F.col("n_rows") / limit).cast("int").alias("parts")
    crowds = keys.filter(F.col("n_rows") > limit).select("key", parts)
    placed = (
        shown.withColumn("slot", slot(F.col("key"), bits))
        .join(F.broadcast(slots.select("slot", "bucket")), "slot")
        .join(F.broadcast(crowds), "key", "left")
        .withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), "parts"), F.lit(0)))
        .withColumn("crowded", F.col("parts").isNotNull())
    )
    owned = (
        placed.repartition("bucket", "part")
        .groupBy("bucket", "part", "key", "crowded", "text")
        .agg(F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select("bucket", "key", "crowded", F.octet_length("text").cast("bigint").alias("n_bytes"),
                F.unhex(F.sha2("text", 256)).alias("digest"), F.when(F.col("crowded"), F.col("text")).alias("text"),
                "keep_id", "group_size")
    )
    owned = saved(owned, "index-owned")
    again = owned.filter("crowded").groupBy("bucket", "key", "n_bytes", "digest", "text").agg(
        F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    entries = owned.filter(~F.col("crowded")).drop("crowded", "text").unionByName(again.drop("text"))
    chain = Window.partitionBy("bucket", "key").orderBy("keep_id", "digest")
    entries = entries.repartition("bucket").withColumn("chain", F.row_number().over(chain))
    entries = saved(entries.sortWithinPartitions("bucket", "key", "chain"), "index-entries")
    return Index(slots, entries, rows, limit, bits)


def groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = BUCKET_BYTES, crowd: int = CROWD_ROWS
) -> DataFrame:
    """Per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal when they are so after runs of white space became one space;
    null counts as empty, so null, empty and texts of nothing are two groups: the
    empty text and one space.  ``keep_id`` is the smallest id of the equal texts,
    null only if none has an id; a row without an id is kept only in such a group.
    Rows are not merged: rows with one id and text each count, and all are kept if
    one is.  An empty table gives no rows, and other columns are not read.
    """
    with scratch(docs.sparkSession):
        index = build(docs, id_col, text_col, capacity, crowd)
        found = index.entries.select(
            F.col("key").alias("_key"), F.col("digest").alias("_digest"), "keep_id", "group_size"
        )
        large = found.filter(F.col("group_size") > index.limit).withColumnsRenamed({"keep_id": "_keep", "group_size": "_size"})
        rows = index.rows.join(
            F.broadcast(large), (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest")), "left"
        ).select("id", "digest", "key", "_keep", "_size")
        # Rows of large groups have what they need; they go anywhere in the join below.
        rows = rows.withColumn("key", F.when(F.col("_size").isNull(), F.col("key")).otherwise(F.xxhash64("id")))
        small = found.filter(F.col("group_size") <= index.limit)
        alike = (F.col("key") == F.col("_key")) & (F.col("digest") == F.col("_digest"))
        keep = F.when(F.col("_size").isNull(), F.col("keep_id")).otherwise(F.col("_keep"))
        result = rows.join(small, alike, "left").select(
            F.col("id").alias(id_col),
            keep.alias("keep_id"),
            F.coalesce("_size", "group_size").alias("group_size"),
            F.col("id").eqNullSafe(keep).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
        return saved(result, "exact-groups", outlives=True)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, whose id is the smallest among equal texts.

    Of rows with one id and equal texts, and of equal texts without any id, one stays.
    """
    kept = groups(docs, id_col, text_col).filter("kept").select(F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_digest"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    digest = F.unhex(F.sha2(normalised(F.col(text_col)), 256)).alias("_d")
    rows = docs.select(row, F.col(id_col).alias("_i"), digest).dropDuplicates(["_i", "_d"])
    alike = F.col("_i").eqNullSafe(F.col("_id")) & (F.col("_d") == F.col("_digest"))
    return rows.join(kept, alike, "left_semi").select("_row.*")
