"""Structured Streaming runs of the log: at-least-once (T1, T2), effectively-once (T3, K3), foreach.

The streaming checkpoint is the authority on progress: offsets of a micro-batch are logged before it
runs and committed after its sink returns. A batch that failed is run again with the same id and the
same data, so a sink keyed by batch id (dynamic partition overwrite) stores it exactly once, while a
plain append stores it twice (at-least-once). The user-visible ledger is written by the batch itself.
"""

from __future__ import annotations

import contextlib
import io
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.codec import decode_posts
from ..operators.ledger import commit_ledger
from ..operators.projections import deliveries, split_bad
from ..operators.sink import first_success_per_key, init_sink
from ..operators.table import ResultTable
from ..schema import LEDGER_SCHEMA
from ..session import path_exists

BatchFn = Callable[[DataFrame, int], None]


def start_batches(
    stream: DataFrame,
    process: BatchFn,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start ``process(batch_df, batch_id)`` per micro-batch; ``available_now`` drains what exists and stops."""
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def drain(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the query to finish what it has; stop it if it is still running; surface a failure."""
    finished = query.awaitTermination(timeout_s) if timeout_s is not None else query.awaitTermination()
    if finished is False and query.isActive:
        query.stop()
    error = query.exception()
    if error is not None:
        raise error


def drain_polls(query: StreamingQuery) -> None:
    """T7 for sources that poll (:mod:`ledgerline.sources.offsets`): take micro-batches until a poll finds nothing,
    then stop; surface a failure."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    error = query.exception()
    if error is not None:
        raise error


def write_ledger(batch: DataFrame, ledger_path: str, batch_id: int) -> None:
    """K6: next offsets of this batch, stored under ``batch_id`` (a replayed batch replaces its rows)."""
    (
        commit_ledger(batch)
        .withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
        .select(*LEDGER_SCHEMA.fieldNames())
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(ledger_path)
    )


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """The read-side ledger: latest next offset per partition (monotone: a late batch never moves it back)."""
    rows = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)
    return rows.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


# Target bytes per shuffle partition inside a micro-batch (AQE does not coalesce there).
BYTES_PER_SHUFFLE_PARTITION = 64 << 20
# What a record takes beside its value: key, position, row overhead.
RECORD_BYTES = 100


def size_shuffles(spark: SparkSession, n_bytes: int, ceiling: dict) -> int:
    """Size this stream's shuffles to the micro-batch: one partition per 64 MB, never more
    than the session's own setting (read once into ``ceiling``). ``spark`` is the stream's session (a
    clone made when the query started), so the caller's session is not affected."""
    if "n" not in ceiling:
        ceiling["n"] = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(1, min(ceiling["n"], -(-n_bytes // BYTES_PER_SHUFFLE_PARTITION)))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def at_least_once_writer(sink_path: str, fn: Callable[[DataFrame], DataFrame] | None = None,
                         ledger_path: str | None = None) -> BatchFn:
    """Append ``fn(batch)`` (default: the post deliveries); a replayed batch is appended again."""
    transform = fn or (lambda df: deliveries(decode_posts(df)))

    def process(batch: DataFrame, batch_id: int) -> None:
        transform(batch).write.mode("append").parquet(sink_path)
        if ledger_path:
            write_ledger(batch, ledger_path, batch_id)

    return process


def exactly_once_writer(sink_path: str, ledger_path: str | None = None,
                        quarantine_path: str | None = None, on_error: str = "quarantine",
                        batch_base: int = 0) -> BatchFn:
    """Per batch, decode strictly, keep the first storable record per key, drop keys already
    stored, and commit the rest to the result table as ``batch_id``.

    A batch that runs again after its commit finds itself stored; one that failed before it left nothing. The
    ledger is written after the table, under the same batch id. ``batch_base`` shifts the stored batch ids (a run
    that resumes from the table itself continues after the batches already stored).
    """
    ceiling: dict = {}

    def process(batch: DataFrame, stream_batch_id: int) -> None:
        batch_id = batch_base + stream_batch_id
        spark = batch.sparkSession
        table = ResultTable(spark, sink_path)
        batch = batch.persist()
        kept: list[DataFrame] = []
        try:
            # materialises the batch
            n_bytes = batch.agg(F.sum(F.coalesce(F.octet_length("value"), F.lit(0)) + RECORD_BYTES)).first()[0] or 0
            size_shuffles(spark, n_bytes, ceiling)
            decoded = decode_posts(batch, on_error=on_error)
            if not table.holds(batch_id):
                # computed once: probed against the table, then written
                kept.append(first_success_per_key(decoded).persist())
                kept.append(table.new_rows(kept[0]).persist())
                table.append(kept[1], batch_id)
                table.compact()
            if quarantine_path:
                _, bad = split_bad(decoded)
                (
                    bad.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
                    .write.mode("overwrite")
                    .option("partitionOverwriteMode", "dynamic")
                    .partitionBy("batch_id")
                    .parquet(quarantine_path)
                )
            if ledger_path:
                write_ledger(batch, ledger_path, batch_id)
        finally:
            for df in [*kept, batch]:
                df.unpersist()

    return process


def run_at_least_once(stream: DataFrame, sink_path: str, checkpoint: str,
                      fn: Callable[[DataFrame], DataFrame] | None = None, ledger_path: str | None = None,
                      available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """T1/T2 (restrict ``stream`` to assigned partitions for T2). ``available_now=False`` keeps it
    running, one micro-batch per ``processing_time`` (e.g. "1 second", the poll wait) until drained."""
    process = at_least_once_writer(sink_path, fn, ledger_path)
    return start_batches(stream, process, checkpoint, available_now, processing_time)


def run_exactly_once(stream: DataFrame, sink_path: str, checkpoint: str, ledger_path: str | None = None,
                     quarantine_path: str | None = None, available_now: bool = True,
                     reset: bool = False, resume: bool = False) -> StreamingQuery:
    """Effectively-once result table.

    A new checkpoint needs a new or emptied sink (see init_sink), unless ``resume``: then the run
    continues a table that other runs filled (the stored-offset consumer). Build ``stream`` with
    ``start_offsets=resume_point(spark, sink_path)`` so every partition is read from its max stored
    offset (inclusive; the re-read record is rejected by the key check). The batch ids of this run
    continue after the stored ones; the base is kept in the checkpoint folder for restarts.
    """
    base = batch_base(stream.sparkSession, sink_path, checkpoint, resume, reset)
    process = exactly_once_writer(sink_path, ledger_path, quarantine_path, batch_base=base)
    return start_batches(stream, process, checkpoint, available_now)


def batch_base(spark: SparkSession, sink_path: str, checkpoint: str, resume: bool, reset: bool) -> int:
    """What a run adds to its batch ids: 0 for a new table, the batches already stored for one that it continues;
    kept in the checkpoint folder for restarts."""
    if _checkpoint_started(spark, checkpoint):
        return _read_base(spark, checkpoint)
    base = 0
    if resume and ResultTable.exists(spark, sink_path):
        top = ResultTable(spark, sink_path).manifest().last_batch
        base = 0 if top is None else top + 1
    else:
        init_sink(spark, sink_path, reset=reset)
    _write_base(spark, checkpoint, base)
    return base


def resume_point(spark: SparkSession, sink_path: str) -> DataFrame:
    """Start offsets (topic, partition, start_offset) to continue a result table: max stored offset, from its manifest."""
    return ResultTable(spark, sink_path).starts(inclusive=True)


def _base_path(checkpoint: str) -> str:
    return checkpoint.rstrip("/") + "/ledgerline-batch-base"


def _write_base(spark: SparkSession, checkpoint: str, base: int) -> None:
    spark.createDataFrame([(int(base),)], "base long").coalesce(1).write.mode("overwrite").json(_base_path(checkpoint))


def _read_base(spark: SparkSession, checkpoint: str) -> int:
    if not path_exists(spark, _base_path(checkpoint)):
        return 0
    row = spark.read.schema("base long").json(_base_path(checkpoint)).first()
    return 0 if row is None else int(row["base"])


def run_foreach(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                available_now: bool = True) -> StreamingQuery:
    """Source -> foreach(fn). ``fn`` gets each micro-batch as a DataFrame (side effects go here)."""
    return start_batches(stream, fn, checkpoint, available_now)


def describe(stream: DataFrame, mode: str = "formatted") -> str:
    """The plan of a stream before it runs (the counterpart of printing a topology)."""
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        stream.explain(mode)
    return out.getvalue()


def _checkpoint_started(spark: SparkSession, checkpoint: str) -> bool:
    return path_exists(spark, checkpoint + "/offsets")


def run_highest_offset(stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """G2 as a stateful stream: max offset per partition, ``update`` mode (one state row per partition,
    bounded by the partition count). Each micro-batch's changed rows are appended with the batch id;
    :func:`read_highest` takes the latest per partition."""

    def append_updates(updates: DataFrame, batch_id: int) -> None:
        updates.withColumn("batch_id", F.lit(int(batch_id)).cast("long")).write.mode("append").parquet(out_path)

    progress = stream.groupBy("topic", "partition").agg(F.max("offset").alias("max_offset"))
    writer = (
        progress.writeStream.outputMode("update")
        .foreachBatch(append_updates)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_highest(spark: SparkSession, out_path: str) -> DataFrame:
    """Latest max offset per partition from the appended updates, and the next offset to commit."""
    rows = spark.read.schema("topic string, partition int, max_offset long, batch_id long").parquet(out_path)
    return rows.groupBy("topic", "partition").agg(
        F.max("max_offset").alias("max_offset"), (F.max("max_offset") + 1).alias("next_offset")
    )
