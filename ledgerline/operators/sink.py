"""The result table of effectively-once delivery (K2, K3, J2, Q3, Q4) and publishing (K1, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import encode_post, key_partition
from ..session import path_exists, scratch_table
from .joins import BROADCAST_MAX_ROWS, fits_broadcast, join_bounded
from .projections import storable
from .table import ResultTable

# JSON text stored for a tombstone (the value NULL written as JSON).
TOMBSTONE_JSON = "null"


def first_success_per_key(decoded: DataFrame) -> DataFrame:
    """Q3: per key, the first storable record in (partition, offset) order; tombstones stored as ``null``.

    A ``min`` over a struct is a partial aggregate: a key with a huge number of copies is reduced inside
    each map task before the shuffle, unlike a ``row_number`` window that would ship every copy.
    """
    first = storable(decoded).groupBy("key").agg(
        F.min(F.struct("partition", "offset", "topic", "value")).alias("_first")
    )
    return first.select(
        F.col("key").alias("id"),
        F.coalesce(F.col("_first.value"), F.lit(TOMBSTONE_JSON)).alias("post_json"),
        F.col("_first.topic").alias("topic"),
        F.col("_first.partition").cast("long").alias("topic_partition"),
        F.col("_first.offset").alias("partition_offset"),
    )


def new_ids(
    batch: DataFrame,
    stored: DataFrame,
    key_col: str = "id",
    max_rows: int = BROADCAST_MAX_ROWS,
    n_keys: int | None = None,
    keys_unique: bool = False,
) -> DataFrame:
    """Rows of ``batch`` whose key is not yet in ``stored`` (its ``id`` column).

    A micro-batch is bounded by the trigger, the stored table is not: the batch's distinct keys are
    broadcast (after a size check) and the stored ids are only scanned, never shuffled. The stored ids
    that matched are at most the batch's keys, so the final anti-join is broadcast as well.
    ``n_keys`` (an upper bound on the batch's distinct keys, e.g. its row count) skips the count;
    ``keys_unique`` (one row per key already) skips the distinct.
    """
    keys = batch.select(F.col(key_col).alias("_id"))
    if not keys_unique:
        keys = keys.distinct()  # partial aggregate: a hot key collapses map-side
    if n_keys is None:
        n_keys = keys.count()
    ids = stored.select(F.col("id").alias("_id"))
    # a stored table may repeat an id: what matches is one row per key, whatever the table holds
    if fits_broadcast(keys, n_keys, max_rows):
        hits = ids.join(F.broadcast(keys), "_id", "left_semi").distinct()
        return batch.join(F.broadcast(hits), batch[key_col] == hits["_id"], "left_anti")
    # too many keys to broadcast: match distinct keys (one row per key on both sides, balanced), then
    # bring the matched keys back by broadcast when they fit, so the batch is not shuffled by key
    hits = scratch_table(ids.join(keys, "_id", "left_semi").distinct(), "matched-ids")
    side = F.broadcast(hits) if fits_broadcast(hits, hits.count(), max_rows) else hits
    return batch.join(side, batch[key_col] == side["_id"], "left_anti")


def init_sink(spark: SparkSession, path: str, reset: bool = False) -> DataFrame:
    """K2: create the (empty) result table; refuse a non-empty one unless ``reset``.

    A new checkpoint restarts batch ids at 0, so it must start on a new or emptied sink.
    """
    return ResultTable.create(spark, path, reset=reset).read()


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """The result table as of now (see :class:`ledgerline.operators.table.ResultTable`)."""
    return ResultTable(spark, path).read()


def write_sink_batch(rows: DataFrame, path: str, batch_id: int) -> bool:
    """K3: store one batch; a batch that is stored already is left as it is (False)."""
    spark = rows.sparkSession
    table = ResultTable(spark, path) if ResultTable.exists(spark, path) else ResultTable.create(spark, path)
    if table.holds(batch_id):
        return False
    rows = rows.persist()
    try:
        return table.append(rows, batch_id)
    finally:
        rows.unpersist()


def publish(
    df: DataFrame,
    fields: dict,
    key,
    topic: str,
    n_partitions: int,
    path: str | None = None,
    fmt: str = "parquet",
    kafka: dict | None = None,
    order_by: tuple[str, ...] = ("key",),
) -> None:
    """K1: publish rows as log records (key = ``key``, value = JSON of ``fields``) to ``topic``.

    ``fmt="kafka"`` writes with the connector (the broker assigns offsets). ``fmt="parquet"`` appends to
    a stored log as a broker would: each record goes to its key's partition and gets the next offsets
    of that partition, in ``order_by`` order (the send order; must be unique), after the offsets the
    log already holds. Offsets come from :func:`ranged_positions`, so a hot partition is numbered by
    many tasks. One writer at a time per log.
    """
    if fmt == "kafka":
        from ..sources.kafka import kafka_write_options

        opts = kafka_write_options(topic=topic, **(kafka or {}))
        published_records(df, fields, key, topic, n_partitions).select("key", "value").write.format("kafka").options(**opts).save()
        return
    from ..sources.log import log_heads, write_log
    from .ordering import ranged_positions

    spark = df.sparkSession
    # rows go to their ranges as they are, and are encoded there: JSON is larger, and as many tasks as there are ranges write it
    sent = df.withColumns({"_ll_key": key.cast("string"), "_ll_topic": F.lit(topic)}).withColumn("_ll_part", key_partition(F.col("_ll_key"), n_partitions))
    order = ["_ll_key" if c == "key" else c for c in order_by]
    placed = ranged_positions(sent, ["_ll_topic", "_ll_part"], order, "_ll_pos").rows
    ranged = True
    if path_exists(spark, path):
        # one row per partition already in the log: its next offset
        heads = log_heads(spark, path).select("topic", "partition", (F.col("greatest") + 1).alias("_ll_base"))
        heads = heads.withColumnsRenamed({"topic": "_ll_topic", "partition": "_ll_part"})
        base = scratch_table(heads, "heads")  # from footers, before this append adds to them
        n_base = base.count()
        ranged = fits_broadcast(base, n_base)  # a broadcast join keeps the ranged layout
        placed = join_bounded(placed, base, ["_ll_topic", "_ll_part"], "left", rows=n_base)
        offset = F.coalesce(F.col("_ll_base"), F.lit(0)) + F.col("_ll_pos")
    else:
        offset = F.col("_ll_pos")
    log = placed.select(
        F.col("_ll_key").alias("key"), encode_post(fields).alias("value"), F.col("_ll_topic").alias("topic"), F.col("_ll_part").alias("partition"), offset.cast("long").alias("offset"),
        F.lit(None).cast("timestamp_ntz").alias("timestamp"),
    )
    write_log(log, path, mode="append", prepartitioned=ranged)


def published_records(
    df: DataFrame, fields: dict, key, topic: str, n_partitions: int, keep: tuple[str, ...] = ()
) -> DataFrame:
    """K1/F2: the records a producer sends for ``df``: key, JSON value, topic and key partition
    (plus the ``keep`` columns of ``df``, e.g. to order the records)."""
    return df.select(
        key.cast("string").alias("key"),
        encode_post(fields).alias("value"),
        F.lit(topic).alias("topic"),
        *keep,
    ).withColumn("partition", key_partition(F.col("key"), n_partitions))


# Column types of the result table in a database (K2): the key is the primary key.
JDBC_COLUMN_TYPES = {
    "id": "VARCHAR(70)",
    "post_json": "CLOB",
    "topic": "VARCHAR(70)",
    "topic_partition": "BIGINT",
    "partition_offset": "BIGINT",
}


def jdbc_create_table(table: str) -> str:
    """K2: DDL of the result table (primary key on ``id``)."""
    cols = ", ".join(f"{c} {t}" for c, t in JDBC_COLUMN_TYPES.items())
    return f"CREATE TABLE {table} ({cols}, PRIMARY KEY (id))"


def jdbc_merge(table: str, staging_table: str) -> str:
    """K4: move a staged batch into the result table, skipping keys already stored (the primary-key
    rejection of a per-record insert, done once per batch). Running it twice changes nothing."""
    cols = ", ".join(JDBC_COLUMN_TYPES)
    return (
        f"INSERT INTO {table} ({cols}) SELECT {cols} FROM {staging_table} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {table} t WHERE t.id = s.id)"
    )


def sink_jdbc(rows: DataFrame, url: str, staging_table: str, properties: dict | None = None) -> None:
    """K4: stage one batch of result rows in ``staging_table`` (overwrite: a retried batch replaces it).

    A JDBC append is not atomic across tasks, hence the staging table; the database then applies
    :func:`jdbc_merge` in one statement. Needs a reachable database; not exercised here, where no
    database may be started.
    """
    props = dict(properties or {})
    props.setdefault("createTableColumnTypes", ", ".join(f"{c} {t}" for c, t in JDBC_COLUMN_TYPES.items()))
    rows.select(*JDBC_COLUMN_TYPES).write.mode("overwrite").jdbc(url, staging_table, properties=props)
