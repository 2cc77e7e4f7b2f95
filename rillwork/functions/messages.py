"""Messages in a seven-column envelope, and the codecs of their payload."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns and types every message source delivers.
ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)


def to_envelope(
    df: DataFrame, key: Column, value: Column, topic: str, offset: Column, timestamp: Column
) -> DataFrame:
    """Rows as messages: text key and value become bytes."""
    return df.select(
        F.encode(key, "UTF-8").alias("key"),
        F.encode(value, "UTF-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        offset.cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def text_of(messages: DataFrame, *others: str) -> DataFrame:
    """Key and value as text, with any other envelope columns asked for."""
    return messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *others
    )


def decode_json(messages: DataFrame, schema: str) -> DataFrame:
    """The JSON payload as typed columns; unreadable payloads give nulls."""
    record = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(record.alias("data")).select("data.*")


def _avro():
    try:
        from pyspark.sql.avro import functions as avro
    except ImportError as missing:  # pragma: no cover - part of pyspark
        raise RuntimeError("start Spark with the spark-avro package to use the avro codec") from missing
    return avro


def read_avro_schema(path: str) -> str:
    """The text of an Avro schema file on the driver, as ``decode`` takes it."""
    return Path(path).read_text(encoding="utf-8")


def encode(record: Column, codec: str) -> Column:
    """A struct as payload bytes.  ``avro`` needs the spark-avro package on the class path."""
    if codec == "json":
        return F.encode(F.to_json(record), "UTF-8")
    if codec == "avro":
        return _avro().to_avro(record)
    raise ValueError(f"unknown codec {codec!r}")


def decode(payload: Column, codec: str, schema: str) -> Column:
    """Payload bytes as a struct; ``schema`` is DDL for json and an Avro schema for avro."""
    if codec == "json":
        return F.from_json(payload.cast("string"), schema)
    if codec == "avro":
        return _avro().from_avro(payload, schema)
    raise ValueError(f"unknown codec {codec!r}")
