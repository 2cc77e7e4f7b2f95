"""Files in and out.

Readers take the schema where there is one: inferring it reads the data twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.functions.text import literal


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines as ``value``."""
    return spark.read.option("lineSep", "\n").text(path)


def read_fields(spark: SparkSession, path: str, names: Sequence[str], separator: str = "\t") -> DataFrame:
    """Separated text without quoting; the last field takes the rest of the line."""
    fields = F.split("value", literal(separator), len(names))
    lines = read_lines(spark, path).select(fields.alias("_f"))
    return lines.select(*[F.get("_f", i).alias(n) for i, n in enumerate(names)])


def read_csv(
    spark: SparkSession, path: str, schema: str | None = None, header: bool = True, **options: str
) -> DataFrame:
    """CSV files; without a schema the types are inferred with a pass over the data."""
    reader = spark.read.options(header=header, **options)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_json(spark: SparkSession, path: str, schema: str | None = None, documents: bool = False) -> DataFrame:
    """JSON records: one per line, or files that are one document each.

    A file of the second kind is read by one task, so it should be of bounded size.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", documents).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, one_file: bool = False, mode: str = "errorifexists", **options: str) -> None:
    """CSV with a header.  ``one_file`` sends everything through one task: for small reports only."""
    out = df.coalesce(1) if one_file else df
    out.write.mode(mode).options(header=True, **options).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_json_documents(
    df: DataFrame, path: str, key: str, records_per_file: int = 10_000, mode: str = "errorifexists"
) -> None:
    """Files that each hold one JSON array of about ``records_per_file`` records.

    Records are spread evenly over the documents by a hash of the unique ``key``.
    """
    documents = -(-max(df.count(), 1) // records_per_file)
    spread = F.pmod(F.xxhash64(key), F.lit(documents)).alias("_doc")
    records = df.select(spread, F.struct("*").alias("_r")).groupBy("_doc")
    text = F.to_json(F.collect_list("_r"))
    records.agg(text.alias("value")).select("value").write.mode(mode).option(
        "maxRecordsPerFile", 1
    ).text(path)


def write_lines(df: DataFrame, path: str, line: str, mode: str = "errorifexists") -> None:
    df.select(line).write.mode(mode).option("lineSep", "\n").text(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)
