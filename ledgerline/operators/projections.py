"""Projections and filters over log rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import OK, SKIP

NULL_KEY = "null_key"


def drop_tombstones(log: DataFrame) -> DataFrame:
    """Records that carry a value. Compute progress (ledgers) on the unfiltered log, not on this."""
    return log.where(F.col("value").isNotNull())


def deliveries(decoded: DataFrame) -> DataFrame:
    """What the per-record callback reports: post id, partition and offset of each decoded post."""
    return decoded.where(F.col("decode_status") == OK).select(
        F.col("post.id").alias("post_id"), "partition", "offset"
    )


def next_offsets(log: DataFrame) -> DataFrame:
    """The committable position after each record (offset + 1)."""
    return log.select("topic", "partition", (F.col("offset") + 1).alias("next_offset"))


def for_partition(df: DataFrame, topic: str, partition: int, partition_col: str = "topic_partition") -> DataFrame:
    """Rows of one (topic, partition). On a stored log the predicate prunes folders; in a result table it reaches
    the row groups, which follow the log's order in part (see :mod:`ledgerline.operators.table`)."""
    return df.where((F.col("topic") == topic) & (F.col(partition_col) == partition))


def key_value(log: DataFrame) -> DataFrame:
    """P5: key and raw value, no decode and no tombstone filter."""
    return log.select("key", "value")


def failure_reason(decoded: DataFrame, require_key: bool = True):
    """Reason a decoded record cannot be stored (NULL when it can)."""
    status = F.col("decode_status")
    reason = F.when(status.isin(OK, SKIP), F.lit(None).cast("string")).otherwise(status)
    if require_key:
        reason = F.when(F.col("key").isNull(), F.lit(NULL_KEY)).otherwise(reason)
    return reason


def storable(decoded: DataFrame, require_key: bool = True) -> DataFrame:
    """The accepted side of :func:`split_bad` alone (decoded or tombstone, with a key)."""
    ok = F.col("decode_status").isin(OK, SKIP)
    return decoded.where(ok & F.col("key").isNotNull()) if require_key else decoded.where(ok)


def split_bad(decoded: DataFrame, require_key: bool = True) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine) from one decoded frame; quarantine keeps the record and its reason.

    A sink that stores rows by key needs a key: a NULL key is quarantined as ``null_key``.
    """
    tagged = decoded.withColumn("_reason", failure_reason(decoded, require_key))
    accepted = tagged.where(F.col("_reason").isNull()).drop("_reason")
    quarantine = tagged.where(F.col("_reason").isNotNull()).select(
        "key", "value", "topic", "partition", "offset", F.col("_reason").alias("reason")
    )
    return accepted, quarantine
