"""Streaming jobs over files or a message broker.

A job takes a streaming DataFrame and a place to write to and returns the
started query; offsets and state live in the checkpoint folder, so a job that is
started again goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillwork.functions.messages import decode, encode
from rillwork.sources import versions


def stream_files(
    spark: SparkSession, path: str, schema, file_format: str = "json", **options: str
) -> DataFrame:
    """A directory whose new files are the stream; the schema is fixed."""
    return spark.readStream.schema(schema).options(**options).format(file_format).load(path)


def _start(df: DataFrame, checkpoint: str, mode: str, drain: bool):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True) if drain else writer


def append_files(
    df: DataFrame, path: str, checkpoint: str, file_format: str = "parquet", drain: bool = False
) -> StreamingQuery:
    """New rows to files, each exactly once.  ``drain`` stops when the input is used up."""
    return _start(df, checkpoint, "append", drain).format(file_format).start(path)


def append_topic(
    df: DataFrame, servers: str, topic: str, checkpoint: str, drain: bool = False
) -> StreamingQuery:
    """New messages to a topic."""
    writer = _start(df, checkpoint, "append", drain).format("kafka")
    return writer.option("kafka.bootstrap.servers", servers).option("topic", topic).start()


def show_on_console(
    df: DataFrame, checkpoint: str, mode: str = "append", drain: bool = False
) -> StreamingQuery:
    """Rows of each batch to the console, for looking at."""
    return _start(df, checkpoint, mode, drain).format("console").start()


def reencode(messages: DataFrame, schema: str, codec: str) -> DataFrame:
    """JSON messages as messages of another codec, one ``value`` column."""
    record = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(record).select(encode(F.struct("data.*"), codec).alias("value"))


def redecode(messages: DataFrame, codec: str, schema: str) -> DataFrame:
    """Messages of a codec as typed columns."""
    return messages.select(decode(F.col("value"), codec, schema).alias("data")).select("data.*")


def counts(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows seen so far per key; the state holds one number per key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _versioned(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def replace_each_batch(
    df: DataFrame, path: str, checkpoint: str, drain: bool = False, kept: int = versions.KEPT
) -> StreamingQuery:
    """Complete output: every batch writes the whole result to a folder of its own.

    A batch that is run again after a failure overwrites its own folder.  The last
    ``kept`` folders stay.
    """

    def write(result: DataFrame, batch: int) -> None:
        result.write.mode("overwrite").parquet(_versioned(path, batch))
        for old in versions.finished(result.sparkSession, path, "batch")[:-kept]:
            versions.remove(result.sparkSession, _versioned(path, old))

    return _start(df, checkpoint, "complete", drain).foreachBatch(write).start()


def upsert_each_batch(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    checkpoint: str,
    drain: bool = False,
    buckets: int = 32,
    kept: int = versions.KEPT,
) -> StreamingQuery:
    """Update output: changed rows replace those of the same key.

    A batch writes its changed rows as deltas per bucket of keys, and a manifest; a
    bucket whose deltas outgrew it is put together anew.  A batch that is run again
    starts from the manifest before it.  The last ``kept`` versions stay readable.
    """

    def write(changed: DataFrame, batch: int) -> None:
        versions.upsert(changed, path, keys, batch, buckets, kept)

    return _start(df, checkpoint, "update", drain).foreachBatch(write).start()


def last_version(spark: SparkSession, path: str) -> DataFrame:
    """What a versioned sink holds after its last batch; it may be empty."""
    if versions.versions(spark, path):
        return versions.read(spark, path)
    return spark.read.parquet(_versioned(path, versions.finished(spark, path, "batch")[-1]))


def finish(query: StreamingQuery, timeout: int = 600) -> StreamingQuery:
    """Wait for a draining query; fail if it failed or is still running."""
    if not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream still running after {timeout} s")
    return query
