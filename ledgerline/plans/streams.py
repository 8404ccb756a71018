"""Named stream queries: each drives a Structured Streaming run over a stored log to the end
(``availableNow``) and returns the table it produced.

Input: a stored log that grows by a few parallel appends, each continuing every partition where the one
before it stopped; the stream runs after each append and takes it whole, so records arrive in offset order.
The number of jobs does not depend on the size of the log. Replays and seeks read the stored log itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.joins import join_bounded
from ..operators.projections import key_value
from ..operators.sink import read_sink
from ..schema import LOG_COLUMNS, LOG_SCHEMA
from ..session import scratch_path, sized_session
from ..sources.log import read_log_stream, stored_log, stored_log_path, write_log
from ..sources.offsets import read_log_polls
from ..sources.zones import read_zones
from ..streaming.keyed import keyed_state_session, run_exactly_once_keyed
from ..streaming.runs import (
    drain,
    drain_polls,
    read_highest,
    read_ledger,
    resume_point,
    run_at_least_once,
    run_exactly_once,
    run_foreach,
    run_highest_offset,
)

# Fixed scenario values: assigned partitions (T2), appends that a log arrives in, and state partitions of
# the stateful stream.
ASSIGNED = [3, 7, 11]
APPENDS = 3
STATE_PARTITIONS = 8

_DELIVERY_SCHEMA = "post_id string, partition int, offset long"
_QUARANTINE_SCHEMA = "key string, value string, partition int, offset long, reason string"


def appends(spark: SparkSession, sf_dir: str, n: int = APPENDS) -> list[DataFrame]:
    """The log in ``n`` parts: the first share of every partition, the next one, and so on."""
    log = stored_log(spark, sf_dir)
    sizes = log.groupBy("topic", "partition").agg(F.count(F.lit(1)).alias("_n"))
    marked = join_bounded(log, sizes, ["topic", "partition"])  # one row per partition
    part = F.least(F.floor(F.col("offset") * n / F.col("_n")), F.lit(n - 1))
    return [marked.where(part == i).select(*LOG_COLUMNS) for i in range(n)]


def feed(spark: SparkSession, sf_dir: str, run: Callable[[str], StreamingQuery]) -> None:
    """Appends the log part by part to a stored log, and drains ``run(path)`` after each append."""
    path = scratch_path(spark, "fed-log")
    for part in appends(spark, sf_dir):
        write_log(part, path, mode="append", prepartitioned=True)
        drain(run(path))


def _stream(spark: SparkSession, path: str, partitions: list[int] | None = None) -> DataFrame:
    return read_log_stream(spark, "table", path=path, partitions=partitions)


def q_log_stream_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1/S3 stream: every record from the earliest position, into a file sink (exactly once by its log)."""
    out, ckpt = scratch_path(spark, "stream-scan"), scratch_path(spark, "ckpt")

    def store(path: str) -> StreamingQuery:
        writer = _stream(spark, path).writeStream.format("parquet").option("path", out)
        return writer.option("checkpointLocation", ckpt).trigger(availableNow=True).start()

    feed(spark, sf_dir, store)
    return spark.read.schema(LOG_SCHEMA).parquet(out).select("key", "value", "topic", "partition", "offset")


def q_key_value_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source -> foreach, each batch's (key, value) handed to a function that appends them."""
    out, ckpt = scratch_path(spark, "foreach"), scratch_path(spark, "ckpt")

    def append_pairs(batch: DataFrame, batch_id: int) -> None:
        key_value(batch).write.mode("append").parquet(out)

    feed(spark, sf_dir, lambda path: run_foreach(_stream(spark, path), append_pairs, ckpt))
    return spark.read.schema("key string, value string").parquet(out)


def q_at_least_once_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries appended per micro-batch (a normal run, no failure)."""
    out, ckpt = scratch_path(spark, "alo"), scratch_path(spark, "ckpt")
    feed(spark, sf_dir, lambda path: run_at_least_once(_stream(spark, path), out, ckpt))
    return spark.read.schema(_DELIVERY_SCHEMA).parquet(out)


def q_assigned_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At-least-once over explicitly assigned partitions."""
    out, ckpt = scratch_path(spark, "assigned"), scratch_path(spark, "ckpt")
    feed(spark, sf_dir, lambda path: run_at_least_once(_stream(spark, path, ASSIGNED), out, ckpt))
    return spark.read.schema(_DELIVERY_SCHEMA).parquet(out)


def q_exactly_once_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The effectively-once result table after the whole log has streamed through."""
    sink, ckpt = scratch_path(spark, "eo-sink"), scratch_path(spark, "ckpt")
    feed(spark, sf_dir, lambda path: run_exactly_once(_stream(spark, path), sink, ckpt))
    return read_sink(spark, sink).drop("batch_id")


def q_stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6/T5: the ledger the effectively-once run wrote, one commit per micro-batch, read as latest per partition."""
    sink, ledger, ckpt = scratch_path(spark, "eo-sink"), scratch_path(spark, "ledger"), scratch_path(spark, "ckpt")
    feed(spark, sf_dir, lambda path: run_exactly_once(_stream(spark, path), sink, ckpt, ledger_path=ledger))
    return read_ledger(spark, ledger)


def _delivery_counts(spark, out) -> DataFrame:
    return (
        spark.read.schema(_DELIVERY_SCHEMA).parquet(out)
        .groupBy("post_id", "partition", "offset")
        .agg(F.count(F.lit(1)).alias("deliveries"))
    )


def q_resume_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 keep: stopped after the first half, restarted on the same checkpoint when more arrives: each once."""
    src, out, ckpt = scratch_path(spark, "resume-src"), scratch_path(spark, "resume"), scratch_path(spark, "ckpt")
    for part in appends(spark, sf_dir, 2):
        write_log(part, src, mode="append", prepartitioned=True)
        drain(run_at_least_once(_stream(spark, src), out, ckpt))
    return _delivery_counts(spark, out)


def q_replay_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 renew: a second run with a fresh checkpoint replays everything into the same appended sink."""
    src = stored_log_path(spark, sf_dir)
    out = scratch_path(spark, "replay")
    for _ in range(2):
        drain(run_at_least_once(_stream(spark, src), out, scratch_path(spark, "ckpt")))
    return _delivery_counts(spark, out)


def q_seek_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 in a stream: restart from the stopped consumer's result table (max stored offset per
    partition, inclusive) instead of a checkpoint; deliveries from there on."""
    from .catalog import stopped_starts

    out, ckpt = scratch_path(spark, "seek"), scratch_path(spark, "ckpt")
    starts = stopped_starts(spark, sf_dir)
    stream = read_log_stream(spark, "table", path=stored_log_path(spark, sf_dir), start_offsets=starts)
    drain(run_at_least_once(stream, out, ckpt))
    return spark.read.schema(_DELIVERY_SCHEMA).parquet(out)


def q_highest_offset_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 streaming: a stateful max per partition over delivered posts, in update mode."""
    from ..functions.codec import decode_posts

    out, ckpt = scratch_path(spark, "highest"), scratch_path(spark, "ckpt")
    # one state row per log partition: a few state partitions hold it, whatever the cluster's setting
    state = sized_session(spark, STATE_PARTITIONS)

    def track(path: str) -> StreamingQuery:
        return run_highest_offset(decode_posts(_stream(state, path)).where(F.col("decode_status") == "ok"), out, ckpt)

    feed(spark, sf_dir, track)
    return read_highest(spark, out)


def q_exactly_once_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 with a keyed state index (the stored ids of a bucket of keys) instead of a look-up in the table."""
    sink, ckpt = scratch_path(spark, "eo-keyed"), scratch_path(spark, "ckpt")
    keyed = keyed_state_session(spark)
    feed(spark, sf_dir, lambda path: run_exactly_once_keyed(_stream(keyed, path), sink, ckpt))
    return read_sink(spark, sink).drop("batch_id")


def q_resume_table_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3/T4 + J1: a table that one run filled is continued by a keyed run with a new checkpoint, whose index is
    filled from the stored ids."""
    src, sink = scratch_path(spark, "resume-table-src"), scratch_path(spark, "resume-table")
    early, late = appends(spark, sf_dir, 2)
    write_log(early, src, mode="append", prepartitioned=True)
    drain(run_exactly_once(_stream(spark, src), sink, scratch_path(spark, "ckpt")))
    write_log(late, src, mode="append", prepartitioned=True)
    keyed = keyed_state_session(spark)
    resumed = read_log_stream(keyed, "table", path=src, start_offsets=resume_point(spark, sink))
    drain(run_exactly_once_keyed(resumed, sink, scratch_path(spark, "ckpt"), resume=True))
    return read_sink(spark, sink).drop("batch_id")


def q_resume_table_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3 + J1 + S4: the stored-offset consumer. A first run stores the first half; later a run with a
    new checkpoint resumes from the table itself (max stored offset per partition, inclusive)."""
    src, sink = scratch_path(spark, "resume-table-src"), scratch_path(spark, "resume-table")
    early, late = appends(spark, sf_dir, 2)
    write_log(early, src, mode="append", prepartitioned=True)
    drain(run_exactly_once(_stream(spark, src), sink, scratch_path(spark, "ckpt")))
    write_log(late, src, mode="append", prepartitioned=True)
    resumed = read_log_stream(spark, "table", path=src, start_offsets=resume_point(spark, sink))
    drain(run_exactly_once(resumed, sink, scratch_path(spark, "ckpt"), resume=True))
    return read_sink(spark, sink).drop("batch_id")


def q_stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P6 in a stream: the records that the effectively-once run routed away, with the reason."""
    sink, bad, ckpt = scratch_path(spark, "eo-sink"), scratch_path(spark, "bad"), scratch_path(spark, "ckpt")
    feed(spark, sf_dir, lambda path: run_exactly_once(_stream(spark, path), sink, ckpt, quarantine_path=bad))
    return spark.read.schema(_QUARANTINE_SCHEMA).parquet(bad).drop("batch_id")


# Fixed scenario value: the producer publishes `events` in two appends, split at this event time.
PUBLISH_SPLIT = "2024-01-16 00:00:00"


def q_published_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 -> S1 -> K3 end to end: `events` published to a stored log in two appends (offsets continue),
    the log tailed as a stream into the effectively-once table after each append (same checkpoint)."""
    from ..operators.sink import publish
    from ..sources.fixtures import post_fields

    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    topic_path, sink, ckpt = scratch_path(spark, "published-log"), scratch_path(spark, "published-sink"), scratch_path(spark, "ckpt")
    early = F.col("ts") < F.lit(PUBLISH_SPLIT).cast("timestamp_ntz")
    for part in (events.where(early), events.where(~early)):
        publish(part, post_fields(part), F.col("event_id"), "posts", 20, path=topic_path)
        drain(run_exactly_once(read_log_stream(spark, "table", path=topic_path), sink, ckpt))
    return read_sink(spark, sink).drop("batch_id")


#: Fixed scenario value: polls that the longest partition's backlog is read in.
POLLS = 4
_POLL_SCHEMA = "key string, partition int, offset long, poll long"


def _polled(spark: SparkSession, stream: DataFrame) -> DataFrame:
    """Every record of a polled stream with the micro-batch that brought it."""
    out, ckpt = scratch_path(spark, "polls"), scratch_path(spark, "ckpt")

    def store(batch: DataFrame, batch_id: int) -> None:
        tagged = batch.select("key", "partition", "offset", F.lit(batch_id).cast("long").alias("poll"))
        tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("poll").parquet(out)

    drain_polls(run_foreach(stream, store, ckpt, available_now=False))
    return spark.read.schema(_POLL_SCHEMA).parquet(out)


def _poll_size(spark: SparkSession, path: str) -> int:
    longest = read_zones(spark, path).agg(F.max("greatest")).first()[0]
    return max(1, -(-((longest or 0) + 1) // POLLS))


def q_paced_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog read in bounded micro-batches, each partition's next records at a time."""
    path = stored_log_path(spark, sf_dir)
    return _polled(spark, read_log_polls(spark, path, records=_poll_size(spark, path)))


def q_paced_seek_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assigned partitions in bounded micro-batches from where the stopped consumer's table ends."""
    from .catalog import ASSIGNED as assigned, stopped_starts

    path = stored_log_path(spark, sf_dir)
    return _polled(spark, read_log_polls(spark, path, records=_poll_size(spark, path), partitions=assigned, start_offsets=stopped_starts(spark, sf_dir)))


STREAM_QUERIES = {
    "paced_stream": q_paced_stream,
    "paced_seek_stream": q_paced_seek_stream,
    "published_stream": q_published_stream,
    "resume_table_stream": q_resume_table_stream,
    "resume_table_keyed": q_resume_table_keyed,
    "exactly_once_keyed": q_exactly_once_keyed,
    "highest_offset_stream": q_highest_offset_stream,
    "seek_stream": q_seek_stream,
    "log_stream_scan": q_log_stream_scan,
    "key_value_stream": q_key_value_stream,
    "at_least_once_stream": q_at_least_once_stream,
    "assigned_stream": q_assigned_stream,
    "exactly_once_sink": q_exactly_once_sink,
    "stream_ledger": q_stream_ledger,
    "stream_quarantine": q_stream_quarantine,
    "resume_stream": q_resume_stream,
    "replay_stream": q_replay_stream,
}
