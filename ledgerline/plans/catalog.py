"""Named queries over the given tables: each takes (spark, sf_dir) and returns a DataFrame.

Every query reads `events` (through the stored log L1 derived from it) or another given table, so its
work grows with the data. Scenario values (which partitions a reader is assigned, how far a consumer
got before it stopped) are fixed below.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_posts
from ..functions.columns import stable_index, stable_key
from ..operators.audit import audit_duplicates, audit_missing, completion_frontier, missing_ranges
from ..operators.ledger import (
    commit_ledger,
    commits_per_batch,
    highest_offset,
    records_by_partition,
    sink_max_offset,
    starts_from_ledger,
)
from ..operators.joins import join_bounded
from ..operators.ordering import OrderedFold, decouple, fold_in_order, in_partition_order, ordered_positions, ranged_positions
from ..operators.projections import deliveries, drop_tombstones, for_partition, next_offsets, split_bad
from ..operators.sink import first_success_per_key, published_records, read_sink, write_sink_batch
from ..operators.split import assign_splits, even_split
from ..operators.table import ResultTable
from ..schema import POST_SCHEMA, TOPIC
from ..session import input_stamp, scratch_path
from ..sources.fixtures import post_fields
from ..sources.log import log_heads, log_partitions, partition_count, poll_batches, read_log, stored_log, stored_log_path

# Fixed scenario values: partitions assigned to one reader; the consumer that stopped half-way;
# chunk counts for splitting.
ASSIGNED = [3, 7, 11]
STOPPED_EMPTY = 3  # partitions with this remainder modulo 7 had stored nothing
PREDICATE_PARTITION = 7
SPLIT_K = 7
READERS_K = 6
PUBLISH_PARTITIONS = 20

_sinks: dict[tuple, str] = {}


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_log(spark, sf_dir)


def halves(log: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The log of a consumer that stopped after half of each partition, and the rest of it; some
    partitions it had not begun. Both grow with the log."""
    stop = log.groupBy("topic", "partition").agg(F.floor(F.count(F.lit(1)) / 2).alias("_stop"))
    stop = stop.withColumn("_stop", F.when(F.col("partition") % 7 == STOPPED_EMPTY, 0).otherwise(F.col("_stop")))
    marked = join_bounded(log, stop, ["topic", "partition"])  # one row per partition
    order = log.columns
    return marked.where("offset < _stop").select(*order), marked.where("offset >= _stop").select(*order)


def _sink_key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return spark.sparkContext.applicationId, input_stamp(spark, f"{sf_dir}/events.parquet"), name


def _stored_sink(spark: SparkSession, sf_dir: str, name: str, log: DataFrame) -> DataFrame:
    key = _sink_key(spark, sf_dir, name)
    if key not in _sinks:
        path = scratch_path(spark, f"sink-{name}")
        write_sink_batch(first_success_per_key(decode_posts(log)), path, 0)
        _sinks[key] = path
    return read_sink(spark, _sinks[key])


def stopped_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result table of a consumer that stored the first half of the log (batch 0)."""
    return _stored_sink(spark, sf_dir, "stopped", halves(_log(spark, sf_dir))[0])


def stopped_starts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where that consumer goes on, from its table's manifest."""
    stopped_sink(spark, sf_dir)
    return ResultTable(spark, _sinks[_sink_key(spark, sf_dir, "stopped")]).starts()


def full_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result table after the whole log (batch 0), for the audits."""
    return _stored_sink(spark, sf_dir, "full", _log(spark, sf_dir))


# --- scans and sources -------------------------------------------------------------------------------

def q_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole topic as a table."""
    return _log(spark, sf_dir).select("key", "value", "topic", "partition", "offset")


def q_assigned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the assigned partitions (directory pruning)."""
    log = read_log(spark, stored_log_path(spark, sf_dir), partitions=ASSIGNED)
    return log.select("key", "value", "topic", "partition", "offset")


def q_poll_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's poll when a poll reads at most 100 records per partition."""
    return poll_batches(_log(spark, sf_dir)).select("key", "partition", "offset", "poll")


def q_partition_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7."""
    return log_partitions(_log(spark, sf_dir))


def q_partition_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8, from file footers."""
    return partition_count(log_heads(spark, stored_log_path(spark, sf_dir)))


# --- projections and filters ------------------------------------------------------------------------

def q_drop_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1."""
    return drop_tombstones(_log(spark, sf_dir)).select("key", "value", "partition", "offset")


def q_post_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(post id, partition, offset) of every delivered post, retries included."""
    return deliveries(decode_posts(_log(spark, sf_dir)))


def q_next_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Committable offset of each record."""
    return next_offsets(_log(spark, sf_dir))


def q_partition_predicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows of one (topic, partition)."""
    rows = for_partition(full_sink(spark, sf_dir), TOPIC, PREDICATE_PARTITION)
    return rows.select("id", "post_json", "topic_partition", "partition_offset")


def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that cannot be stored, with the reason."""
    _, bad = split_bad(decode_posts(_log(spark, sf_dir)))
    return bad.select("key", "value", "partition", "offset", "reason")


def q_decode_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """strictly decoded posts."""
    decoded = decode_posts(_log(spark, sf_dir)).where(F.col("decode_status") == "ok")
    return decoded.select("post.*", "partition", "offset")


# --- ledgers and resume -----------------------------------------------------------------------------

def q_commit_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1/K6: next offset per partition after reading the whole log, from file footers."""
    heads = log_heads(spark, stored_log_path(spark, sf_dir))
    return commit_ledger(heads.withColumnRenamed("greatest", "offset"))


def q_highest_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Highest delivered offset per partition (a partial aggregate, no order needed)."""
    decoded = decode_posts(_log(spark, sf_dir))
    return highest_offset(decoded.where(F.col("decode_status") == "ok"))


def q_sink_max_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resume position per partition from the stopped consumer's table; 0 when none stored."""
    return sink_max_offset(stopped_sink(spark, sf_dir), log_partitions(_log(spark, sf_dir)))


def q_records_by_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G4."""
    return records_by_partition(_log(spark, sf_dir))


def q_commits_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G5."""
    return commits_per_batch(_log(spark, sf_dir))


def q_resume_from_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1/S4 inclusive: what the stopped consumer reads when it restarts from its result table
    (a seek on the stored log, from the positions in the table's manifest)."""
    return read_log(spark, stored_log_path(spark, sf_dir), start_offsets=stopped_starts(spark, sf_dir)).select("key", "partition", "offset")


def q_resume_from_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 exclusive: restart from the committed ledger of the stopped consumer."""
    starts = starts_from_ledger(commit_ledger(halves(_log(spark, sf_dir))[0]))
    return read_log(spark, stored_log_path(spark, sf_dir), start_offsets=starts).select("key", "partition", "offset")


def q_new_ids_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 batch form: records after the stop whose key is not stored yet (bitmaps first, then few stored ids)."""
    _, later = halves(_log(spark, sf_dir))
    stopped_sink(spark, sf_dir)
    table = ResultTable(spark, _sinks[_sink_key(spark, sf_dir, "stopped")])
    return table.new_rows(later, key_col="key").select("key", "partition", "offset")


# --- ordering, split, merge ---------------------------------------------------------------------------

def q_ordered_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: position of each delivered record in its partition, in offset order."""
    # project before ranking: the ranked rows are checkpointed, and only these columns are needed
    delivered = drop_tombstones(_log(spark, sf_dir)).select("key", "topic", "partition", "offset")
    return ordered_positions(delivered).select("key", "partition", "offset", "position")


class RunningChecksum(OrderedFold):
    """A checksum chained through a partition's records: c' = (31 c + key) mod P. A run of records is c -> a c + b."""

    start = 0
    schema = "key string, partition int, offset long, checksum long"
    factor, prime = 31, 1_000_000_007

    def summary(self, rows):
        a, b = 1, 0
        for key in rows["key"]:
            a, b = a * self.factor % self.prime, (b * self.factor + int(key)) % self.prime
        return a, b

    def combine(self, left, right):
        return left[0] * right[0] % self.prime, (left[1] * right[0] + right[1]) % self.prime

    def enter(self, state, summary):
        return (state * summary[0] + summary[1]) % self.prime

    def run(self, state, rows):
        chained = []
        for key in rows["key"]:
            state = (state * self.factor + int(key)) % self.prime
            chained.append(state)
        return rows[["key", "partition", "offset"]].assign(checksum=chained), state


def q_running_checksum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 with state: every record's checksum over its partition so far, in offset order, in many tasks."""
    return fold_in_order(_log(spark, sf_dir).select("topic", "partition", "offset", "key"), RunningChecksum())


def _gaps(frames):
    """The callback's own view: per frame, how far each record is from the one before it in the same partition."""
    for pdf in frames:
        yield pdf.assign(gap=pdf.groupby(["topic", "partition"])["offset"].diff().fillna(1).astype("int64"))[["key", "partition", "offset", "gap"]]


def q_ordered_callback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: a callback without state over records in offset order (1: in order and nothing between)."""
    slim = _log(spark, sf_dir).select("topic", "partition", "offset", "key")
    return in_partition_order(slim, _gaps, "key string, partition int, offset long, gap long")


def q_decoupled_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: decode in lanes independent of the log partitions (order-free result)."""
    decoded = decode_posts(decouple(_log(spark, sf_dir))).where(F.col("decode_status") == "ok")
    return decoded.select(F.col("post.id").alias("post_id"), F.col("post.author").alias("author"), "partition", "offset")


def q_per_partition_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: each partition's sub-stream on its own, unordered across partitions: partial aggregates in every task."""
    return _log(spark, sf_dir).groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("value").isNull()).alias("n_tombstones"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


def q_even_split_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5, tail rows spread over the first chunks."""
    rows = _log(spark, sf_dir).select("key", "partition", "offset")
    return even_split(rows, SPLIT_K, ["partition", "offset"], equal=True).select("key", "partition", "offset", "split_id")


def q_even_split_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O5, tail rows all in the last chunk."""
    rows = _log(spark, sf_dir).select("key", "partition", "offset")
    return even_split(rows, SPLIT_K, ["partition", "offset"], equal=False).select("key", "partition", "offset", "split_id")


def q_reader_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partition list split over readers."""
    # strict=False: the same rule, defined for every partition count (a small log may hold fewer
    # partitions than the documented 20, e.g. 15 into 6 readers, where the sequential splitter throws)
    assigned = assign_splits(log_partitions(_log(spark, sf_dir)), READERS_K, strict=False)
    return assigned.select("split_id", F.col("partitions.partition").cast("string").alias("partitions"))


def q_merged_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reader's assigned partitions in one scan, each record with its reader."""
    log = _log(spark, sf_dir)
    readers = assign_splits(log_partitions(log), READERS_K, strict=False).select("split_id", F.inline("partitions"))
    return join_bounded(log, readers, ["topic", "partition"]).select("key", "partition", "offset", "split_id")  # one row per partition


# --- publish, callbacks, audits -----------------------------------------------------------------------

def q_publish_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records a producer sends for every event."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return published_records(events, post_fields(events), F.col("event_id"), TOPIC, PUBLISH_PARTITIONS)


def q_publish_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events published under generated keys: UUID-shaped and repeatable, with an index of 32 bits."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    sent = events.withColumn("_key", stable_key("event_id", "event_type")).withColumn("index", stable_index("event_id", "event_type"))
    return published_records(sent, post_fields(sent), F.col("_key"), TOPIC, PUBLISH_PARTITIONS, keep=("index",))


def _document_post(docs):
    return {"id": F.col("doc_id"), "author": F.col("source"), "description": F.col("lang"), "text": F.col("text")}


def q_publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1 + F1: documents published to a stored log (key partition, offsets in key order), read back and
    decoded (long texts, quotes, line breaks, nulls)."""
    from ..operators.sink import publish

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = scratch_path(spark, "published")
    publish(docs, _document_post(docs), F.col("doc_id"), "documents", PUBLISH_PARTITIONS, path=path)
    decoded = decode_posts(read_log(spark, path)).where(F.col("decode_status") == "ok")
    return decoded.select("post.*", "partition", "offset")


def q_udf_process(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The standard per-record callback as a DataFrame -> DataFrame function."""

    def report(df: DataFrame) -> DataFrame:
        return df.select(
            F.format_string("%s at %d/%d", "post_id", "partition", "offset").alias("delivered"),
        )

    return deliveries(decode_posts(_log(spark, sf_dir))).transform(report)


def q_audit_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts delivered more than once (producer retries)."""
    return audit_duplicates(deliveries(decode_posts(_log(spark, sf_dir))), ["post_id", "partition"])


def q_audit_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log records that the result table does not hold, and whether their key is stored."""
    return audit_missing(_log(spark, sf_dir), full_sink(spark, sf_dir))


# Fixed scenario value: polls (of 100 offsets) with this remainder modulo 3 were processed twice.
RETRIED = 0


def completed_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tasks report as done: every delivered record, and again in tens where its poll was retried."""
    done = decode_posts(_log(spark, sf_dir)).where("decode_status = 'ok'").select("topic", "partition", "offset")
    once = done.select("topic", "partition", F.col("offset").alias("lo"), (F.col("offset") + 1).alias("hi"))
    tens = done.where(F.floor(F.col("offset") / 100) % 3 == RETRIED).groupBy("topic", "partition", F.floor(F.col("offset") / 10).alias("ten"))
    # a retried task covers the records around it only if all of its ten were delivered
    again = tens.agg(F.count(F.lit(1)).alias("n"), F.min("offset").alias("lo"), (F.max("offset") + 1).alias("hi")).where("n = 10")
    return once.unionAll(again.select("topic", "partition", "lo", "hi"))


def q_completion_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each partition is complete without a hole, and what is missing beyond."""
    return completion_frontier(completed_intervals(spark, sf_dir))


def q_missing_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranges of offsets that no task completed."""
    return missing_ranges(completed_intervals(spark, sf_dir))


def conversation_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` published as a keyed log: key = conversation, one post per turn, sent in turn
    order, so offsets in each partition follow (conversation, turn)."""
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    fields = {
        "id": F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")),
        "author": F.col("role"),
        "description": F.concat(F.lit("turn"), F.col("turn").cast("string")),
        "text": F.col("text"),
    }
    sent = published_records(conv, fields, F.col("conv_id"), "conversations", PUBLISH_PARTITIONS, keep=("conv_id", "turn"))
    placed = ranged_positions(sent, ["partition"], ["conv_id", "turn"], "offset").rows
    return placed.select("key", "value", "topic", "partition", "offset", F.lit(None).cast("timestamp_ntz").alias("timestamp"))


def q_conversation_firsts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 on real multi-row keys and non-ASCII text: the first stored post of each conversation."""
    firsts = first_success_per_key(decode_posts(conversation_log(spark, sf_dir)))
    post = F.from_json("post_json", POST_SCHEMA)
    return firsts.select(
        "id", post["id"].alias("post_id"), post["author"].alias("author"), post["text"].alias("text"),
        "topic_partition", "partition_offset",
    )


def q_first_success_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3 batch twin of the effectively-once sink: first storable record per key."""
    return first_success_per_key(decode_posts(_log(spark, sf_dir)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "log_scan": q_log_scan,
    "assigned_scan": q_assigned_scan,
    "poll_batches": q_poll_batches,
    "partition_list": q_partition_list,
    "partition_count": q_partition_count,
    "drop_tombstones": q_drop_tombstones,
    "post_deliveries": q_post_deliveries,
    "next_offsets": q_next_offsets,
    "partition_predicate": q_partition_predicate,
    "quarantine": q_quarantine,
    "decode_posts": q_decode_posts,
    "commit_ledger": q_commit_ledger,
    "highest_offset": q_highest_offset,
    "sink_max_offset": q_sink_max_offset,
    "records_by_partition": q_records_by_partition,
    "commits_per_batch": q_commits_per_batch,
    "resume_from_sink": q_resume_from_sink,
    "resume_from_ledger": q_resume_from_ledger,
    "new_ids_only": q_new_ids_only,
    "ordered_position": q_ordered_position,
    "running_checksum": q_running_checksum,
    "ordered_callback": q_ordered_callback,
    "decoupled_process": q_decoupled_process,
    "per_partition_summary": q_per_partition_summary,
    "even_split_equal": q_even_split_equal,
    "even_split_last": q_even_split_last,
    "reader_assignment": q_reader_assignment,
    "merged_scan": q_merged_scan,
    "publish_encode": q_publish_encode,
    "publish_keyed": q_publish_keyed,
    "publish_roundtrip": q_publish_roundtrip,
    "udf_process": q_udf_process,
    "audit_duplicates": q_audit_duplicates,
    "audit_missing": q_audit_missing,
    "completion_frontier": q_completion_frontier,
    "missing_ranges": q_missing_ranges,
    "first_success_per_key": q_first_success_per_key,
    "conversation_firsts": q_conversation_firsts,
}

from .streams import STREAM_QUERIES  # noqa: E402

QUERIES.update(STREAM_QUERIES)
