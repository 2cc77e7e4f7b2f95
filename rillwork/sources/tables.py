"""Catalog databases and tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.operators.ordered import BROADCAST_KEYS, dealt, lookup
from rillwork.operators.sets import union_distinct
from rillwork.session import cut_lineage

#: Rows of a file in a partitioned table.
FILE_ROWS = 2_000_000


def sql_over(text: str, **frames: DataFrame) -> DataFrame:
    """A SQL query over DataFrames that the text names in braces; no view of the session is touched."""
    return next(iter(frames.values())).sparkSession.sql(text, **frames)


def make_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a database; its tables go below ``location``."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")


def save_table(
    df: DataFrame, table: str, partition_by: Sequence[str] = (), file_rows: int = FILE_ROWS
) -> DataFrame:
    """Write (or replace) a managed table and read it back through the catalog.

    With partition columns, rows are counted per partition first, and dealt so that
    a partition is as few files of about ``file_rows`` rows as hold it; a large one is
    written by as many tasks.
    """
    writer = df.write
    if partition_by:
        sizes = df.groupBy(*partition_by).agg(F.ceil(F.count(F.lit(1)) / file_rows).cast("int").alias("_files"))
        sizes = cut_lineage(sizes)
        placed = lookup(df, sizes, partition_by, to_all=sizes.count() <= BROADCAST_KEYS)
        placed = dealt(placed, F.col("_files"), "_file")
        writer = placed.repartition(*partition_by, "_file").select(*df.columns).write.partitionBy(*partition_by)
    writer.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def copy_table(spark: SparkSession, source: str, target: str) -> DataFrame:
    return save_table(spark.table(source), target)


def union_tables(spark: SparkSession, sources: Sequence[str], target: str) -> DataFrame:
    """Distinct rows of all source tables, saved as one table."""
    return save_table(union_distinct([spark.table(t) for t in sources]), target)


def external_parquet(spark: SparkSession, table: str, columns: str, location: str) -> DataFrame:
    """A table over Parquet files that exist already; dropping it leaves them alone."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING PARQUET LOCATION '{location}'")
    return spark.table(table)


def quoted_csv_table(spark: SparkSession, table: str, columns: str, quote: str = "'") -> DataFrame:
    """A table of CSV files whose fields may be quoted with ``quote``."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {table} ({columns}) USING csv
        OPTIONS (sep ',', quote "{quote}", escape "{quote}")"""
    )
    return spark.table(table)


def _hidden(spark: SparkSession, table: str) -> tuple[str, Any, Any]:
    """The table's folder, its file system, and the class of paths.  Names with ``_`` are no data there."""
    found = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").first()
    paths = spark._jvm.org.apache.hadoop.fs.Path
    return found.data_type, paths(found.data_type).getFileSystem(spark._jsc.hadoopConfiguration()), paths


def fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``lines`` and ``checksum`` of every text file under a path; the order of lines does not count."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.xxhash64("value").alias("hash"))
    return lines.groupBy("file").agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.col("hash").cast("decimal(38,0)")).cast("string").alias("checksum")
    )


def stage_csv(spark: SparkSession, path: str, table: str, quote: str = "'") -> str | None:
    """Write the rows of files that the table's ledger does not have aside, as a load with a number of its own.

    Returns the number, or None if there is nothing new.  Nothing shows in the table yet.
    """
    folder, system, paths = _hidden(spark, table)
    files = fingerprints(spark, path)
    if system.exists(paths(f"{folder}/_ledger")):
        known = spark.read.schema(files.schema).option("recursiveFileLookup", True).parquet(f"{folder}/_ledger")
        files = files.join(known, files.columns, "left_anti")
    files = cut_lineage(files)
    new = files.agg(F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.array_sort(F.collect_list(
        F.concat_ws(" ", *files.columns))), "\n")).alias("load")).first()
    if not new.n:
        return None
    schema = spark.table(table).schema
    # One name per file of this load; the rows themselves do not pass through here.
    names = [unquote(r.file) for r in files.select("file").collect()]
    rows = spark.read.schema(schema).options(quote=quote, escape=quote).csv(names)
    staged = f"{folder}/_staged/{new.load}"
    files.coalesce(1).write.mode("overwrite").parquet(f"{staged}/files")
    rows.write.mode("overwrite").options(quote=quote, escape=quote).csv(f"{staged}/rows")
    return new.load


def finish_loads(spark: SparkSession, table: str) -> None:
    """Move the rows of staged loads into the table and their files into its ledger.

    Every step may be repeated: a file that was moved is no longer there, and a
    ledger entry is one folder per load.  A load whose rows were not staged to the end
    is dropped.
    """
    folder, system, paths = _hidden(spark, table)
    if not system.exists(paths(f"{folder}/_staged")):
        return
    for load in [s.getPath().getName() for s in system.listStatus(paths(f"{folder}/_staged"))]:
        staged = f"{folder}/_staged/{load}"
        if system.exists(paths(f"{staged}/rows/_SUCCESS")):
            for part in system.listStatus(paths(f"{staged}/rows")):
                name = part.getPath().getName()
                if name.startswith("part-"):
                    system.rename(part.getPath(), paths(f"{folder}/load-{load}-{name}"))
            spark.read.parquet(f"{staged}/files").write.mode("overwrite").parquet(f"{folder}/_ledger/{load}")
        system.delete(paths(staged), True)
    spark.catalog.refreshTable(table)


def load_csv(spark: SparkSession, path: str, table: str, quote: str = "'") -> None:
    """Append CSV files to an existing table once each, read with the table's own types.

    The table's folder has a ledger of the files (name, lines, checksum) that were
    loaded, so loading them again adds nothing.  Rows are staged, moved, and entered
    in the ledger; a load that was stopped is finished by the next one.  While rows
    are moved, readers may see a part of them.  One load per table at a time.
    """
    finish_loads(spark, table)
    if stage_csv(spark, path, table, quote):
        finish_loads(spark, table)


def table_names(spark: SparkSession, database: str) -> DataFrame:
    """Name of every table in a database; temporary views belong to none."""
    return spark.sql(f"SHOW TABLES IN {database}").filter("NOT isTemporary").select("tableName")
