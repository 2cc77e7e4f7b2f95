"""Message brokers as batch source and sink.

The connector is a separate package given to Spark at start; these functions
only set its options.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_topic(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A topic's messages in the seven-column envelope."""
    reader = spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).options(**options).load()


def write_topic(df: DataFrame, servers: str, topic: str) -> None:
    """Rows with ``key`` and ``value`` to a topic."""
    writer = df.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()


def stream_topic(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", **options: str
) -> DataFrame:
    """A topic as an unbounded table, from its earliest message unless told otherwise."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    reader = reader.option("subscribe", topic).option("startingOffsets", starting_offsets)
    return reader.options(**options).load()
