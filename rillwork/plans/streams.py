"""Streams over the event files; the result is what the sink holds at the end of the input."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.functions import messages
from rillwork.plans.registry import Tables, query
from rillwork.session import shared_path
from rillwork.streaming import jobs

RECORD = "event_id bigint, user_id bigint, event_type string, value double"
RECORD_SQL = "SELECT event_id, user_id, event_type, value FROM events"


def _event_stream(t: Tables) -> DataFrame:
    # A pattern that only the table's own name fits: a source path may be a folder of
    # parts or, as a pattern, a single file.
    path = t.path("events")
    return jobs.stream_files(t.spark, f"{path[:-1]}[{path[-1]}]", t.events.schema, "parquet")


def _message_stream(t: Tables) -> DataFrame:
    """Events as messages with a JSON payload."""
    record = F.struct("event_id", "user_id", "event_type", "value")
    return messages.to_envelope(
        _event_stream(t),
        F.col("event_id").cast("string"),
        F.to_json(record),
        "events",
        F.col("event_id"),
        F.col("ts"),
    )


def _appended(t: Tables, df: DataFrame, purpose: str, sink: str | None = None) -> DataFrame:
    """The rows an append job leaves in its folder."""
    sink = sink or shared_path(t.spark, purpose)
    checkpoint = shared_path(t.spark, f"{purpose}-checkpoint")
    jobs.finish(jobs.append_files(df, sink, checkpoint, drain=True))
    return t.spark.read.schema(df.schema).parquet(sink)


@query(RECORD_SQL)
def stream_json_append(t: Tables) -> DataFrame:
    return _appended(t, messages.decode_json(_message_stream(t), RECORD), "decoded")


@query("SELECT CAST(event_id AS VARCHAR) AS key, props AS value, 'events' AS topic, event_id AS \"offset\" FROM events")
def stream_passthrough_append(t: Tables) -> DataFrame:
    sent = messages.to_envelope(
        _event_stream(t),
        F.col("event_id").cast("string"),
        F.col("props"),
        "events",
        F.col("event_id"),
        F.col("ts"),
    )
    return messages.text_of(_appended(t, sent, "passed"), "topic", "offset")


@query("SELECT event_id, event_type, octet_length(encode(event_type)) AS type_bytes FROM events")
def stream_reencode(t: Tables) -> DataFrame:
    """JSON messages sent on in another payload and read back as a batch."""
    encoded = _appended(t, jobs.reencode(_message_stream(t), RECORD, "json"), "encoded")
    rows = jobs.redecode(encoded, "json", RECORD)
    return rows.select("event_id", "event_type", F.octet_length("event_type").cast("bigint").alias("type_bytes"))


@query(RECORD_SQL)
def stream_redecode(t: Tables) -> DataFrame:
    """The sent-on messages as a stream of their own, back to typed rows."""
    first = shared_path(t.spark, "encoded")
    encoded = _appended(t, jobs.reencode(_message_stream(t), RECORD, "json"), "encoded", first)
    again = jobs.stream_files(t.spark, first, encoded.schema, "parquet")
    return _appended(t, jobs.redecode(again, "json", RECORD), "redecoded")


COUNTS_SQL = "SELECT event_type, count(*) AS n FROM events GROUP BY 1"


@query(COUNTS_SQL)
def stream_count_complete(t: Tables) -> DataFrame:
    sink, checkpoint = shared_path(t.spark, "complete"), shared_path(t.spark, "complete-checkpoint")
    counted = jobs.counts(_event_stream(t), ["event_type"])
    jobs.finish(jobs.replace_each_batch(counted, sink, checkpoint, drain=True))
    return jobs.last_version(t.spark, sink)


@query("SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def stream_count_update(t: Tables) -> DataFrame:
    """Counts per user over several batches, with a restart between two of them.

    Half of the events come as two files or more, the others are added after the
    first run has used them up.
    """
    source, sink = shared_path(t.spark, "update-in"), shared_path(t.spark, "update")
    checkpoint = shared_path(t.spark, "update-checkpoint")
    events = t.events.select("event_id", "user_id")
    odd = F.pmod(F.col("event_id"), F.lit(2)) == 1
    for part in (odd, ~odd):
        events.filter(part).repartition(max(2, t.spark.sparkContext.defaultParallelism // 4)).write.mode("append").parquet(source)
        files = max(1, len(t.spark.read.parquet(source).inputFiles()) // 4)
        stream = jobs.stream_files(t.spark, source, events.schema, "parquet", maxFilesPerTrigger=str(files))
        counted = jobs.counts(stream, ["user_id"])
        jobs.finish(jobs.upsert_each_batch(counted, sink, ["user_id"], checkpoint, drain=True))
    return jobs.last_version(t.spark, sink)


@query(RECORD_SQL)
def stream_restart(t: Tables) -> DataFrame:
    """Run over part of the input, stop, add the rest, start again from the checkpoint.

    The two parts are the events with and without an error; no row may be lost
    or come twice.
    """
    source, sink = shared_path(t.spark, "restart-in"), shared_path(t.spark, "restart-out")
    checkpoint = shared_path(t.spark, "restart-checkpoint")
    events = t.events.select("event_id", "user_id", "event_type", "value")
    failed = F.col("event_type") == "error"
    for part in (failed, ~failed):
        events.filter(part).write.mode("append").parquet(source)
        stream = jobs.stream_files(t.spark, source, events.schema, "parquet")
        jobs.finish(jobs.append_files(stream, sink, checkpoint, drain=True))
    return t.spark.read.schema(events.schema).parquet(sink)
