"""Change-data merge that keeps history (slowly changing dimension, type 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, WindowSpec
from pyspark.sql import functions as F

from rillwork.functions.times import iso_day
from rillwork.operators.ordered import near
from rillwork.session import cut_lineage
from rillwork.sources import versions

# Date pattern of the inputs, stand-ins for a missing and an open
# date, and the indicators for active and inactive rows.
DATE_PATTERN = "MM-dd-yyyy"
NO_DATE = "0001-01-01"
OPEN_DATE = "9999-12-31"
ACTIVE, INACTIVE = "A", "I"


def normalised(df: DataFrame, date: str, fill: str | None = None) -> DataFrame:
    """Text dates as ``yyyy-MM-dd``, also where they are so already, with a stand-in for missing ones where given."""
    read = df.withColumn(date, F.coalesce(iso_day(date, DATE_PATTERN), iso_day(date, "yyyy-MM-dd")))
    return read if fill is None else read.fillna(fill, [date])


def merge_history(
    base: DataFrame, updates: DataFrame, key: str, date: str, indicator: str, group_rows: int | None = None
) -> DataFrame:
    """Merge updates into a base table: one open row per key, and closed rows for what it replaced.

    Every date of a key, in the base or in any number of updates, begins a version
    that lasts until the key's next date; the last one is open.  Updates may come in
    any order and more than once: a date that is there already adds nothing, so
    merging the same updates again changes nothing.  The base may be an earlier
    result, closed rows included.  A missing or unreadable date is the earliest one.
    Keys with very many versions are cut into slices.
    """
    dates = [normalised(df, date, NO_DATE).select(key, date) for df in (base, updates)]
    chain = dates[0].unionByName(dates[1]).distinct()

    def chained(rows: DataFrame, window: WindowSpec) -> DataFrame:
        return rows.withColumn("_next", F.lead(date).over(window))

    last = F.col("_next").isNull()
    return near(chain, [key], [date], 1, chained, group_rows).select(
        key,
        date,
        F.coalesce("_next", F.lit(OPEN_DATE)).alias("change_date"),
        F.when(last, F.lit(ACTIVE)).otherwise(F.lit(INACTIVE)).alias(indicator),
    )


def save_history(history: DataFrame, path: str, key: str, ranges: int = 64) -> versions.Manifest:
    """Keep a merged table in ranges of its key, for merges that leave other ranges alone."""
    return versions.save_ranges(history, path, key, ranges)


def merge_saved(
    spark: SparkSession, path: str, updates: DataFrame, date: str, indicator: str, version: int, kept: int = versions.KEPT
) -> versions.Manifest:
    """Merge updates into a saved history as a version: only ranges with changes are read and written.

    Dates of the saved rows are ``yyyy-MM-dd``, those of the updates in the pattern
    of the inputs.  The same version may be written again.
    """
    before = versions.manifest(spark, path, version)
    if before is None:
        raise ValueError(f"no version before {version} under {path}")
    [key] = before.keys
    changes = normalised(updates, date, NO_DATE).select(key, date)
    # Read twice: for the ranges, of which there are few, and for the merge.
    changes = cut_lineage(changes.withColumn("_bucket", versions.bucket_of(before)))
    touched = {r[0] for r in changes.select("_bucket").distinct().collect()}
    found = before._replace(version=version)
    pieces = [p for p in before.pieces if p.bucket in touched]
    old = versions.read_pieces(spark, path, before, pieces)
    merged = merge_history(old, changes.drop("_bucket"), key, date, indicator)
    merged = merged.withColumn("_bucket", versions.bucket_of(before))
    written = versions.write_pieces(merged, path, found, versions.BASE, version)
    rest = [p for p in before.pieces if p.bucket not in touched]
    found = found._replace(pieces=tuple(sorted([*rest, *written])))
    versions.commit(spark, path, found)
    versions.vacuum(spark, path, kept)
    return found
