"""Scanning the log as a table or a stream.

A stored log is parquet partitioned by ``topic`` and ``partition`` with rows sorted by ``offset``
inside each file, so a partition list prunes directories (``PartitionFilters``) and a start offset is
pushed to the row groups (``PushedFilters``).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from ..schema import LOG_COLUMNS, LOG_SCHEMA, MAX_RECORDS_PER_POLL
from ..session import input_stamp, scratch_path
from .fixtures import derived_log
from .zones import add_zones, reach, read_files

_stored: dict[tuple[str, str], str] = {}
POLL_PREFIX = "poll-"


def write_log(log: DataFrame, path: str, mode: str = "errorifexists", prepartitioned: bool = False) -> str:
    """Store a log as a table partitioned by (topic, partition), offset-sorted inside each file.

    The rows are range-partitioned on (topic, partition, offset) first, so each task writes a
    contiguous offset range of few partitions (a hot partition is spread over many files, never one
    task). The new files are added to the log's zone map. ``prepartitioned=True`` skips that shuffle for input already ranged that way (as
    :func:`derived_log` leaves it).
    """
    rows = log.select(*LOG_COLUMNS)
    if not prepartitioned:
        rows = rows.repartitionByRange("topic", "partition", "offset")
    (
        rows.sortWithinPartitions("topic", "partition", "offset")
        .write.mode(mode)
        .partitionBy("topic", "partition")
        .parquet(path)
    )
    add_zones(log.sparkSession, path)
    return path


def read_log(
    spark: SparkSession,
    path: str,
    partitions: list[int] | None = None,
    start_offsets: DataFrame | None = None,
    topic: str | None = None,
) -> DataFrame:
    """S1/S2/S4 batch scan of a stored log.

    ``partitions`` restricts the scan to assigned partitions (pruned directories). ``start_offsets``
    (topic, partition, start_offset) seeks each partition by the rule of :func:`after_starts`: by the zone map, files
    that end before their partition's start are not opened, files that begin at or after it are read as they are,
    and only those that a start falls into are filtered.
    """
    if start_offsets is not None:
        log = _seek_files(spark, path, start_map(start_offsets))
    else:
        log = spark.read.schema(LOG_SCHEMA).parquet(path).select(*LOG_COLUMNS)
    if topic is not None:
        log = log.where(F.col("topic") == topic)
    if partitions is not None:
        log = log.where(F.col("partition").isin(list(partitions)))
    return log


def _seek_files(spark: SparkSession, path: str, starts: DataFrame) -> DataFrame:
    found = reach(spark, path, starts)
    parts = []
    if found.part:
        rows = read_files(spark, path, found.part).select(*LOG_COLUMNS)
        inside = rows.select("topic", "partition").distinct().join(starts, ["topic", "partition"], "left")
        lowest, unlisted = inside.agg(F.min("_start"), F.count_if(F.col("_start").isNull())).first()
        if lowest is not None and not unlisted:  # reaches the row groups
            rows = rows.where(F.col("offset").isNull() | (F.col("offset") >= F.lit(int(lowest))))
        parts.append(after_starts(rows, starts))
    if found.whole:
        parts.append(read_files(spark, path, found.whole).select(*LOG_COLUMNS))
    if not parts:
        return spark.createDataFrame([], LOG_SCHEMA)
    return parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])


def start_map(start_offsets: DataFrame) -> DataFrame:
    """(topic, partition, _start): one row per listed partition, written to the scratch folder, so that
    every later read sees the map as it is now (its source may be a table that a stream writes to)."""
    starts = start_offsets.groupBy("topic", "partition").agg(F.max("start_offset").cast("long").alias("_start"))
    path = scratch_path(start_offsets.sparkSession, "starts")
    starts.write.parquet(path)
    return start_offsets.sparkSession.read.schema(starts.schema).parquet(path)


def after_starts(log: DataFrame, starts: DataFrame) -> DataFrame:
    """The one seek rule, for batches and streams: a record goes if its partition is listed and its offset
    is below the start. A null topic, partition or start equals nothing listed, so such records stay."""
    at = starts.select(F.col("topic").alias("_t"), F.col("partition").alias("_p"), "_start")
    before = (log["topic"] == at["_t"]) & (log["partition"] == at["_p"]) & (log["offset"] < at["_start"])
    return join_bounded(log, at, before, "left_anti").select(*LOG_COLUMNS)


def seek(log: DataFrame, start_offsets: DataFrame) -> DataFrame:
    """Keep records at or after their partition's start offset; unlisted partitions are whole.

    One plan whatever the number of partitions: a size-checked anti join with the start map. When the
    map lists every partition of the log, the lowest start is also a plain predicate on ``offset``,
    which reaches the row groups of a stored log below.
    """
    starts = start_map(start_offsets)
    known = log_partitions(log).join(starts, ["topic", "partition"], "left")
    lowest, unlisted = known.agg(F.min("_start"), F.count_if(F.col("_start").isNull())).first()
    if lowest is not None and not unlisted:
        log = log.where(F.col("offset").isNull() | (F.col("offset") >= F.lit(int(lowest))))
    return after_starts(log, starts)


def _log_key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """A log is derived again once its input has changed."""
    return spark.sparkContext.applicationId, input_stamp(spark, f"{sf_dir}/events.parquet")


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log L1 of ``sf_dir`` as a stored table, written once per application."""
    key = _log_key(spark, sf_dir)
    if key not in _stored:
        tag = hashlib.sha1(key[1].encode()).hexdigest()[:10]
        path = scratch_path(spark, "log", tag)
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        write_log(derived_log(events), path, prepartitioned=True)
        _stored[key] = path
    return read_log(spark, _stored[key])


def stored_log_path(spark: SparkSession, sf_dir: str) -> str:
    stored_log(spark, sf_dir)
    return _stored[_log_key(spark, sf_dir)]


def poll_of(offset: Column, max_records: int = MAX_RECORDS_PER_POLL) -> Column:
    """The poll (batch) a record belongs to when each poll reads at most ``max_records`` per partition."""
    return F.floor(offset / F.lit(max_records)).cast("long")


def poll_batches(log: DataFrame, max_records: int = MAX_RECORDS_PER_POLL) -> DataFrame:
    """Every record tagged with its poll number."""
    return log.withColumn("poll", poll_of(F.col("offset"), max_records))


def log_partitions(log: DataFrame) -> DataFrame:
    """The (topic, partition) pairs present in a log (empty partitions cannot be seen)."""
    return log.select("topic", "partition").distinct()


def log_heads(spark: SparkSession, path: str) -> DataFrame:
    """G1/G3/S7/S8 from file footers: (topic, partition, least, greatest, records), one row per partition of a stored
    log. The aggregates are pushed into the Parquet reader, so no row is read, whatever the log holds."""
    # the version 2 reader alone takes aggregates; the setting is of a sibling session, not the caller's
    sibling = spark.newSession()
    sibling.conf.set("spark.sql.sources.useV1SourceList", "")
    sibling.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    log = sibling.read.schema(LOG_SCHEMA).parquet(path)
    return log.groupBy("topic", "partition").agg(F.min("offset").alias("least"), F.max("offset").alias("greatest"), F.count(F.lit(1)).alias("records"))


def partition_count(log: DataFrame) -> DataFrame:
    """Number of partitions per topic."""
    return log.groupBy("topic").agg(F.countDistinct("partition").cast("long").alias("n_partitions"))


def read_log_stream(
    spark: SparkSession,
    source: str,
    path: str | None = None,
    topic: str | None = None,
    max_files_per_trigger: int | None = None,
    kafka: dict | None = None,
    partitions: list[int] | None = None,
    start_offsets: DataFrame | None = None,
) -> DataFrame:
    """S1/S3/S4 stream scan. ``source="table"`` tails a stored log (:func:`write_log` / :func:`publish`
    appends): by default every new file per trigger, so one append arrives whole in one micro-batch, and
    records arrive in offset order as long as each append continues after the one before it;
    ``max_files_per_trigger`` bounds a micro-batch where only complete delivery matters. ``source="files"``
    reads folders of files dropped one after another (one file per trigger unless told otherwise);
    ``source="kafka"`` builds the reader from :func:`ledgerline.sources.kafka.kafka_options`.

    ``start_offsets`` (topic, partition, start_offset) seeks each partition by the rule of
    :func:`after_starts`; the map is fixed when the stream is built. For Kafka it becomes
    ``startingOffsets``, which must name every partition: ``partitions`` gives them, and those
    without a start are read from the earliest record.
    """
    if source == "kafka":
        from .kafka import full_seek_map, kafka_options

        kopts = dict(kafka or {})
        if topic is not None:
            kopts.setdefault("topic", topic)
        if partitions is not None:
            kopts["partitions"] = list(partitions)  # assign: unassigned partitions are never fetched
        if start_offsets is not None:
            # one row per partition of one topic, as the option text needs them
            starts = start_map(start_offsets).where("_start is not null").collect()
            if len({r["topic"] for r in starts}) > 1:
                raise ValueError("a Kafka seek map covers one topic")
            kopts["starting"] = full_seek_map({int(r["partition"]): int(r["_start"]) for r in starts}, partitions)
        opts = kafka_options(**kopts)
        raw = spark.readStream.format("kafka").options(**opts).load()
        log = raw.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            "topic",
            "partition",
            "offset",
            F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
        )
    elif source == "files":
        # one folder per drop; the glob is listed again per trigger
        log = (
            spark.readStream.schema(LOG_SCHEMA)
            .option("maxFilesPerTrigger", max_files_per_trigger or 1)
            .parquet(f"{path.rstrip('/')}/{POLL_PREFIX}*")
            .select(*LOG_COLUMNS)
        )
    elif source == "table":
        reader = spark.readStream.schema(LOG_SCHEMA).option("basePath", path)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        log = reader.parquet(path).select(*LOG_COLUMNS)
    else:
        raise ValueError(f"unknown source {source!r}")
    if source in ("files", "table"):
        if topic is not None:
            log = log.where(F.col("topic") == topic)
        if partitions is not None:
            log = log.where(F.col("partition").isin(list(partitions)))
        if start_offsets is not None:
            log = after_starts(log, start_map(start_offsets))
    return log
