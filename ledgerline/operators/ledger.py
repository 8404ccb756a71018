"""Progress per partition (G1-G5) and resuming from stored progress.

All of these are grouped aggregates on (topic, partition[, poll]): partial aggregation runs map-side, so
only one row per task and group crosses the shuffle, whatever the skew between partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_RECORDS_PER_POLL
from ..sources.log import poll_of, seek
from .joins import join_bounded


def commit_ledger(batch: DataFrame) -> DataFrame:
    """G1/K6: next offset to read per partition after a batch (``max(offset) + 1``).

    Offsets ascend within a partition, so this equals the last-wins map put of a sequential reader.
    Compute it on the unfiltered batch: tombstones and bad records advance progress too.
    """
    return batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def highest_offset(processed: DataFrame) -> DataFrame:
    """Highest processed offset per partition from completions in any order, and the next offset."""
    return processed.groupBy("topic", "partition").agg(
        F.max("offset").alias("max_offset"), (F.max("offset") + 1).alias("next_offset")
    )


def sink_max_offset(sink: DataFrame, partitions: DataFrame | None = None) -> DataFrame:
    """Max stored offset per partition; with ``partitions`` (topic, partition), absent ones give 0.

    One job for all partitions, instead of one lookup per partition.
    """
    stored = sink.groupBy("topic", F.col("topic_partition").cast("int").alias("partition")).agg(
        F.max("partition_offset").alias("max_offset")
    )
    if partitions is None:
        return stored
    # one row per stored partition on the right: broadcast after the size check
    joined = join_bounded(partitions.select("topic", "partition"), stored, ["topic", "partition"], "left")
    return joined.select(
        "topic", "partition", F.coalesce(F.col("max_offset"), F.lit(0)).cast("long").alias("max_offset")
    )


def records_by_partition(log: DataFrame, max_records: int = MAX_RECORDS_PER_POLL) -> DataFrame:
    """A poll's records grouped by partition: counts and offset range per (poll, partition)."""
    return (
        log.withColumn("poll", poll_of(F.col("offset"), max_records))
        .groupBy("poll", "topic", "partition")
        .agg(
            F.count(F.lit(1)).alias("n_records"),
            F.count("value").alias("n_values"),
            F.min("offset").alias("first_offset"),
            F.max("offset").alias("last_offset"),
        )
    )


def commits_per_batch(log: DataFrame, max_records: int = MAX_RECORDS_PER_POLL) -> DataFrame:
    """The position committed after each poll of each partition (one synchronous commit per poll)."""
    return (
        log.withColumn("poll", poll_of(F.col("offset"), max_records))
        .groupBy("topic", "partition", "poll")
        .agg((F.max("offset") + 1).alias("committed_offset"), F.count(F.lit(1)).alias("n_records"))
    )


def starts_from_sink(sink: DataFrame, inclusive: bool = True) -> DataFrame:
    """Start positions (topic, partition, start_offset) from a result table: its max stored offset,
    inclusive as the stored-offset reader does (the re-read record is then rejected by the key check)."""
    shift = 0 if inclusive else 1
    return sink_max_offset(sink).select("topic", "partition", (F.col("max_offset") + shift).alias("start_offset"))


def starts_from_ledger(ledger: DataFrame) -> DataFrame:
    """Start positions from a ledger: the committed next offset (exclusive of what was processed)."""
    return ledger.groupBy("topic", "partition").agg(F.max("next_offset").alias("start_offset"))


def resume_from_sink(log: DataFrame, sink: DataFrame, inclusive: bool = True) -> DataFrame:
    """Each partition from its max stored offset, or from its beginning when nothing is stored."""
    return seek(log, starts_from_sink(sink, inclusive))


def resume_from_ledger(log: DataFrame, ledger: DataFrame) -> DataFrame:
    """Each partition from its committed next offset, or from its beginning when absent."""
    return seek(log, starts_from_ledger(ledger))
