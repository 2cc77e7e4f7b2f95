"""Tables in versions: pieces per bucket, listed by a manifest per version.

A table's keys are dealt into buckets, by hash or by range.  A piece is the rows
of one bucket that one version wrote: a *base* with all keys of the bucket, or a
*delta* with changed ones.  A version's manifest lists the pieces that make up the
table, so a version writes what it changes and takes over the rest:

    data/kind=delta/version=12/bucket=7/   rows
    manifest/version=12/                   bucket, low, kind, version, rows, and how keys are dealt

A manifest counts once its ``_SUCCESS`` is there.  A version that is written again
starts from the manifest before it and overwrites its own folders, so it may be
repeated any number of times.  One writer at a time is assumed.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from typing import Any, NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE, DELTA = "base", "delta"
#: Deltas of a bucket from which it is compacted however small they are.
MOST_DELTAS = 16
#: Versions that stay readable.
KEPT = 2


class Piece(NamedTuple):
    bucket: int
    kind: str
    version: int
    rows: int


class Manifest(NamedTuple):
    """``lows`` has the smallest key of every range after the first, or None for keys dealt by hash."""

    version: int
    keys: tuple[str, ...]
    schema: T.StructType
    buckets: int
    lows: tuple[Any, ...] | None
    pieces: tuple[Piece, ...]


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def remove(spark: SparkSession, path: str) -> None:
    system, folder = _files(spark, path)
    system.delete(folder, True)


def finished(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the folders ``name=number`` under a path that were written to the end, in order."""
    system, root = _files(spark, path)
    if not system.exists(root):
        return []
    folders = [s.getPath().getName() for s in system.listStatus(root)]
    whole = [f for f in folders if f.startswith(f"{name}=") and system.exists(root.suffix(f"/{f}/_SUCCESS"))]
    return sorted(int(f.partition("=")[2]) for f in whole)


def _manifest_path(path: str, version: int) -> str:
    return f"{path}/manifest/version={version}"


def versions(spark: SparkSession, path: str) -> list[int]:
    return finished(spark, f"{path}/manifest", "version")


def commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Write the manifest of a version; from then on it is the table.  One row per piece."""
    facts = {
        "keys": manifest.keys,
        "schema": manifest.schema.jsonValue(),
        "buckets": manifest.buckets,
        "ranges": None if manifest.lows is None else len(manifest.lows),
    }
    key = manifest.schema[manifest.keys[0]].dataType
    lows = dict(enumerate(manifest.lows or (), 1))
    rows = [(None, None, None, None, lows.get(b), b) for b in lows]
    rows += [(*p, None, None) for p in manifest.pieces]
    schema = T.StructType.fromDDL("bucket int, kind string, version bigint, rows bigint")
    schema = schema.add("low", key).add("range", T.IntegerType())
    df = spark.createDataFrame(rows, schema).withColumn("facts", F.lit(json.dumps(facts)))
    if not rows:
        df = spark.createDataFrame([(None,) * 6], schema).withColumn("facts", F.lit(json.dumps(facts)))
    df.coalesce(1).write.mode("overwrite").parquet(_manifest_path(path, manifest.version))


def manifest(spark: SparkSession, path: str, before: int | None = None) -> Manifest | None:
    """The last version's manifest, or the last one before a version."""
    known = [v for v in versions(spark, path) if before is None or v < before]
    if not known:
        return None
    rows = spark.read.parquet(_manifest_path(path, known[-1])).collect()
    facts = json.loads(rows[0].facts)
    lows = tuple(r.low for r in sorted((r for r in rows if r.range is not None), key=lambda r: r.range))
    pieces = tuple(Piece(r.bucket, r.kind, r.version, r.rows) for r in rows if r.kind is not None)
    return Manifest(
        known[-1], tuple(facts["keys"]), T.StructType.fromJson(facts["schema"]), facts["buckets"],
        None if facts["ranges"] is None else lows, tuple(sorted(pieces)),
    )


def bucket_of(found: Manifest) -> Column:
    """The bucket of a row: by hash, or the number of ranges that begin at or below its key; null keys come first."""
    if found.lows is None:
        return F.pmod(F.xxhash64(*found.keys), F.lit(found.buckets)).cast("int")
    if not found.lows:
        return F.lit(0)
    lows, key = F.array(*[F.lit(v) for v in found.lows]), F.col(found.keys[0])
    steps = len(found.lows).bit_length()

    def step(at: Column, power: Column) -> Column:
        ahead = at + power
        fits = (ahead <= len(found.lows)) & (F.get(lows, ahead - 1) <= key)
        return F.when(fits, ahead).otherwise(at)

    powers = F.array(*[F.lit(1 << i) for i in reversed(range(steps))])
    return F.aggregate(powers, F.lit(0), step)


def read_pieces(spark: SparkSession, path: str, found: Manifest, pieces: Iterable[Piece]) -> DataFrame:
    """Rows of some pieces, with ``_version`` and ``_bucket``."""
    data = f"{path}/data"
    folders = [f"{data}/kind={p.kind}/version={p.version}/bucket={p.bucket}" for p in pieces if p.rows]
    schema = T.StructType(
        [*found.schema.fields, *T.StructType.fromDDL("kind string, version bigint, bucket int").fields]
    )
    if not folders:
        rows = spark.createDataFrame([], schema)
    else:
        rows = spark.read.schema(schema).option("basePath", data).parquet(*folders)
    return rows.select(*found.schema.names, F.col("version").alias("_version"), F.col("bucket").alias("_bucket"))


def newest(rows: DataFrame, found: Manifest) -> DataFrame:
    """Of the rows of each key, the one that the last version wrote."""
    rest = [n for n in found.schema.names if n not in found.keys]
    last = F.max_by(F.struct(F.lit(0).alias("_"), *rest), "_version").alias("_last")
    return rows.groupBy("_bucket", *found.keys).agg(last).select(
        "_bucket", *[F.col(n) if n in found.keys else F.col(f"_last.{n}").alias(n) for n in found.schema.names]
    )


def write_pieces(rows: DataFrame, path: str, found: Manifest, kind: str, version: int) -> list[Piece]:
    """Write rows, which have ``_bucket``, as pieces of a version; each bucket goes to tasks of its own.

    The rows are worked out once; their counts come from the files.
    """
    folder = f"{path}/data/kind={kind}/version={version}"
    if found.lows is None:
        dealt = rows.repartition("_bucket")
    else:
        # A range that outgrew others is written by several tasks.
        dealt = rows.repartitionByRange("_bucket", *found.keys)
    shown = dealt.select(*found.schema.names, F.col("_bucket").alias("bucket"))
    shown.write.mode("overwrite").partitionBy("bucket").parquet(folder)
    schema = T.StructType([*found.schema.fields, T.StructField("bucket", T.IntegerType())])
    counts = rows.sparkSession.read.schema(schema).parquet(folder).groupBy("bucket").count()
    return [Piece(r.bucket, kind, version, r["count"]) for r in counts.collect()]


def read(spark: SparkSession, path: str, found: Manifest | None = None) -> DataFrame:
    """The table as of its last version.  Buckets of a single piece are read as they are."""
    found = found or manifest(spark, path)
    if found is None:
        raise ValueError(f"no finished version under {path}")
    by_bucket: dict[int, list[Piece]] = {}
    for piece in found.pieces:
        by_bucket.setdefault(piece.bucket, []).append(piece)
    single = [p for ps in by_bucket.values() if len(ps) == 1 for p in ps]
    layered = [p for ps in by_bucket.values() if len(ps) > 1 for p in ps]
    rows = read_pieces(spark, path, found, single).select(*found.schema.names)
    if layered:
        rows = rows.unionByName(newest(read_pieces(spark, path, found, layered), found).drop("_bucket"))
    return rows


def _due(pieces: Sequence[Piece], most_deltas: int) -> bool:
    """Whether what was added to a bucket's first piece has outgrown it, or is many pieces."""
    base, *deltas = [p.rows for p in sorted(pieces, key=lambda p: p.version)]
    return len(deltas) >= most_deltas or (len(deltas) > 1 and sum(deltas) > base)


def upsert(
    changed: DataFrame, path: str, keys: Sequence[str], version: int, buckets: int = 32, kept: int = KEPT,
    most_deltas: int = MOST_DELTAS,
) -> Manifest:
    """Write changed rows, one per key, as deltas of a version; they replace earlier rows of their keys.

    Only the changed rows are written, and buckets whose deltas outgrew their base
    are put together anew.  An empty table of changes makes a version without pieces
    of its own.  Null is a key like any other.  The number of buckets is fixed by
    the first version.
    """
    spark = changed.sparkSession
    before = manifest(spark, path, version)
    if before is None:
        before = Manifest(-1, tuple(keys), changed.schema, buckets, None, ())
    found = before._replace(version=version)
    deltas = write_pieces(changed.withColumn("_bucket", bucket_of(found)), path, found, DELTA, version)
    by_bucket: dict[int, list[Piece]] = {}
    for piece in (*before.pieces, *deltas):
        by_bucket.setdefault(piece.bucket, []).append(piece)
    due = {b for b, pieces in by_bucket.items() if _due(pieces, most_deltas)}
    pieces = [p for b, ps in by_bucket.items() if b not in due for p in ps]
    if due:
        layered = read_pieces(spark, path, found, [p for b in due for p in by_bucket[b]])
        pieces += write_pieces(newest(layered, found), path, found, BASE, version)
    found = found._replace(pieces=tuple(sorted(pieces)))
    commit(spark, path, found)
    for p in deltas:
        if p.bucket in due:
            _remove_piece(spark, path, p)
    vacuum(spark, path, kept)
    return found


def save_ranges(df: DataFrame, path: str, key: str, ranges: int) -> Manifest:
    """Write a table as version 0 in about so many ranges of its key."""
    spark = df.sparkSession
    placed = df.repartitionByRange(ranges, key).withColumn("_bucket", F.spark_partition_id())
    found = Manifest(0, (key,), df.schema, ranges, (), ())
    folder = f"{path}/data/kind={BASE}/version=0"
    placed.withColumnRenamed("_bucket", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
    schema = T.StructType([*df.schema.fields, T.StructField("bucket", T.IntegerType())])
    sizes = spark.read.schema(schema).parquet(folder).groupBy("bucket").agg(
        F.min(key).alias("low"), F.count(F.lit(1)).alias("rows")
    )
    # Empty partitions leave gaps; a gap is an empty range between the same bounds.
    known = {r.bucket: r for r in sizes.collect()}
    lows, low = [], None
    for bucket in range(max(known, default=0), 0, -1):
        low = known[bucket].low if bucket in known else low
        lows.append(low)
    pieces = tuple(Piece(b, BASE, 0, r.rows) for b, r in sorted(known.items()))
    found = found._replace(lows=tuple(reversed(lows)), pieces=pieces, buckets=len(lows) + 1)
    commit(spark, path, found)
    return found


def _remove_piece(spark: SparkSession, path: str, p: Piece) -> None:
    remove(spark, f"{path}/data/kind={p.kind}/version={p.version}/bucket={p.bucket}")


def vacuum(spark: SparkSession, path: str, kept: int = KEPT) -> list[Piece]:
    """Remove versions but the last ``kept`` ones, and the pieces that only they list."""
    known = versions(spark, path)
    old = known[:-kept] if kept else []
    if not old:
        return []
    stay = {p for v in known[-kept:] for p in manifest(spark, path, v + 1).pieces}
    gone = sorted({p for v in old for p in manifest(spark, path, v + 1).pieces} - stay)
    for p in gone:
        _remove_piece(spark, path, p)
    for version in old:
        remove(spark, _manifest_path(path, version))
    return gone
