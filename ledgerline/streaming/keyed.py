"""Effectively-once result table with a keyed state index (T3 at scale, O(batch) per micro-batch).

The foreachBatch writer (:mod:`ledgerline.streaming.runs`) tests a micro-batch's keys against the table. Here
the test is a state look-up instead:

1. decode strictly and keep storable records (stateless);
2. reduce every Arrow chunk to its first record per key by (partition, offset) (``mapInPandas``,
   before the shuffle: a key with a third of all records reaches the shuffle once per chunk);
3. group by *bucket of keys* and ``transformWithState``: one Python call holds all keys of a bucket that the batch
   brings, and the state is one value per bucket, the ids that are stored; it is read and written once per bucket
   and batch, whatever the number of keys in it;
4. commit what is new to the result table under the batch's id, so a batch that runs again lands once.

A new checkpoint may continue an old table: the state of each bucket is then filled from the stored ids
(``initialState``), read once. Same result as the foreachBatch writer: first arrival wins across batches, the
smallest (partition, offset) within one. State lives in RocksDB stores under the streaming checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.codec import decode_posts
from ..operators.projections import storable
from ..operators.sink import TOMBSTONE_JSON
from ..operators.table import ResultTable
from .runs import batch_base, start_batches

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Buckets of keys, fixed in the checkpoint: a bucket's ids are one state value, so keep them some
#: thousands a bucket (a call costs a few milliseconds, so not far fewer either).
KEY_BUCKETS = 256
_CANDIDATE_SCHEMA = "bucket int, key string, value string, topic string, partition int, offset long"
_ORDER = ["partition", "offset", "topic"]


def keyed_state_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A sibling session (same context) with RocksDB state stores; build the keyed stream on it.

    ``state_partitions`` is fixed in the checkpoint at the first run; by default the session's shuffle partitions, but
    no more than leave each some buckets of keys. An index of more buckets should have more of them.
    """
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if state_partitions is None:
        state_partitions = min(int(spark.conf.get("spark.sql.shuffle.partitions")), KEY_BUCKETS // 8)
    sibling.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    return sibling


def key_bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _firsts(pdf: pd.DataFrame) -> pd.DataFrame:
    """The first row of each key; only rows of keys that repeat are sorted."""
    repeated = pdf["key"].duplicated(keep=False)
    if not repeated.any():
        return pdf
    some = pdf[repeated].sort_values(["key", *_ORDER], kind="stable").drop_duplicates("key", keep="first")
    return some if repeated.all() else pd.concat([pdf[~repeated], some])


def _first_per_key_in_chunk(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in chunks:
        if len(pdf):
            yield _firsts(pdf)


class StoredIds(StatefulProcessor):
    """Emits the first record of every key that is not stored yet; the state is the bucket's stored ids."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.stored = handle.getValueState("stored", "ids array<string>")

    def _known(self) -> set:
        return set(self.stored.get()[0]) if self.stored.exists() else set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        best = None
        for pdf in rows:  # a key per chunk at most, after the reduction above
            best = _firsts(pdf if best is None else pd.concat([best, pdf]))
        if best is None or not len(best):
            return
        known = self._known()
        fresh = best[~best["key"].isin(known)]
        if len(fresh):
            self.stored.update((sorted(known | set(fresh["key"])),))
            yield fresh[["bucket", "key", "value", "topic", "partition", "offset"]]

    def handleInitialState(self, key, initialState, timerValues) -> None:
        if len(initialState):
            self.stored.update((sorted(self._known() | set(initialState["id"])),))

    def close(self) -> None:
        pass


def first_arrivals(stream: DataFrame, stored: DataFrame | None = None, buckets: int = KEY_BUCKETS, processor: StatefulProcessor | None = None) -> DataFrame:
    """The first storable record of each key over a stream of log records, less those whose key is among the
    ``stored`` ids when the checkpoint begins."""
    from ..session import ship_package

    ship_package(stream.sparkSession)
    candidates = storable(decode_posts(stream)).select(key_bucket(F.col("key"), buckets).alias("bucket"), "key", "value", "topic", "partition", "offset")
    reduced = candidates.mapInPandas(_first_per_key_in_chunk, _CANDIDATE_SCHEMA)
    initial = None
    if stored is not None:
        initial = stored.where("id is not null").select(key_bucket(F.col("id"), buckets).alias("bucket"), "id").groupBy("bucket")
    firsts = reduced.groupBy("bucket").transformWithStateInPandas(
        processor or StoredIds(), outputStructType=_CANDIDATE_SCHEMA, outputMode="append", timeMode="None", initialState=initial)
    return firsts.select(
        F.col("key").alias("id"),
        F.coalesce(F.col("value"), F.lit(TOMBSTONE_JSON)).alias("post_json"),
        "topic",
        F.col("partition").cast("long").alias("topic_partition"),
        F.col("offset").alias("partition_offset"),
    )


def run_exactly_once_keyed(
    stream: DataFrame, sink_path: str, checkpoint: str, available_now: bool = True, resume: bool = False, reset: bool = False,
    buckets: int = KEY_BUCKETS, processor: StatefulProcessor | None = None,
) -> StreamingQuery:
    """T3 with a keyed state index. ``stream`` must come from :func:`keyed_state_session`; ``resume`` continues a table
    that other runs filled, from a new checkpoint (see :func:`ledgerline.streaming.runs.run_exactly_once`)."""
    spark = stream.sparkSession
    base = batch_base(spark, sink_path, checkpoint, resume, reset)
    # the state is filled in a checkpoint's first batch alone. Should that batch run again after its commit, its own
    # ids are among the stored ones: nothing is emitted, and the table has the batch already
    stored = ResultTable(spark, sink_path).read() if resume else None
    firsts = first_arrivals(stream, stored, buckets, processor)

    def commit(batch: DataFrame, batch_id: int) -> None:
        table = ResultTable(batch.sparkSession, sink_path)
        if table.holds(base + batch_id):
            # a stateful batch has to be read for its state to be made
            batch.write.format("noop").mode("overwrite").save()
            return
        batch = batch.persist()
        try:
            table.append(batch, base + batch_id)
        finally:
            batch.unpersist()
        table.compact()

    return start_batches(firsts, commit, checkpoint, available_now)
