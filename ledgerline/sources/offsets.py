"""A stream source over a stored log whose own offsets are the log's: one per partition.

``spark.readStream.format("ledgerline_log").option("path", ...)``; options:

* ``records``: at most so many offsets of each partition per micro-batch (the records of one poll), so a backlog of
  any size is read in bounded micro-batches;
* ``partitions``: comma-separated partitions that the reader is assigned, the others are never opened;
* ``topic``: this topic alone;
* ``starts``: JSON of ``{"topic/partition": offset}``, where a new checkpoint begins; other partitions begin at their first
  record.

A micro-batch has one task per partition, which reads the files that the zone map names and hands on Arrow batches in
offset order. The checkpoint holds the offsets, so a restart goes on where the last batch ended. Records without a
topic, partition or offset have no place here and are not read; files are seen once :func:`add_zones` has listed them
(``write_log`` does). ``path`` must be on a file system that pyarrow opens (local, HDFS, S3, GCS). A source in
Python cannot tell ``availableNow`` how far to go in steps: use :func:`ledgerline.streaming.runs.drain_polls`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..schema import LOG_SCHEMA, MAX_RECORDS_PER_POLL
from ..session import ship_package
from .zones import FOLDER

NAME = "ledgerline_log"
_ARROW = pa.schema([("key", pa.string()), ("value", pa.string()), ("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("timestamp", pa.timestamp("us"))])


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class Span(InputPartition):
    """Offsets [low, high) of one partition, and the files that they may be in."""

    def __init__(self, topic: str, partition: int, low: int, high: int, files: list[str]):
        self.topic, self.partition, self.low, self.high, self.files = topic, partition, low, high, files


class LogStreamReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path = options["path"].rstrip("/")
        self.records = int(options.get("records", MAX_RECORDS_PER_POLL))
        if self.records < 1:
            raise ValueError("records must be 1 or more")
        named = options.get("partitions")
        self.assigned = {int(p) for p in named.split(",") if p.strip()} if named is not None else None
        self.topic = options.get("topic")
        self.starts = {k: int(v) for k, v in json.loads(options.get("starts", "{}")).items()}
        self.position: dict[str, int] | None = None
        self.seen: set[str] = set()
        self.zones: dict[str, list[tuple[int, int, str]]] = {}  # by partition: least, greatest, file

    def _look(self) -> None:
        """The zone map's rows that have come since the last look."""
        system, root = _open(self.path)
        names = [f.path for f in system.get_file_info(pafs.FileSelector(f"{root}/{FOLDER}", allow_not_found=True)) if f.path.endswith(".parquet")]
        for name in sorted(set(names) - self.seen):
            for z in pq.read_table(name, filesystem=system).to_pylist():
                mine = z["topic"] is not None and z["partition"] is not None and z["least"] is not None and (self.topic is None or z["topic"] == self.topic)
                if mine and (self.assigned is None or z["partition"] in self.assigned):
                    self.zones.setdefault(f"{z['topic']}/{z['partition']}", []).append((z["least"], z["greatest"], z["file"]))
            self.seen.add(name)

    def _begin(self, key: str) -> int:
        return self.starts.get(key, min(z[0] for z in self.zones[key]))

    def initialOffset(self) -> dict:
        self._look()
        return {k: self._begin(k) for k in self.zones}

    def latestOffset(self) -> dict:
        self._look()
        at = self.position or {}
        # a partition's end never moves back; one that is new begins at its start
        self.position = {k: max(b := at.get(k, self._begin(k)), min(b + self.records, max(z[1] for z in own) + 1)) for k, own in self.zones.items()} | {k: v for k, v in at.items() if k not in self.zones}
        return self.position

    def partitions(self, start: dict, end: dict) -> list[Span]:
        self._look()
        if self.position is None:  # after a restart: the last batch of the checkpoint is planned again first
            self.position = dict(end)
        spans = []
        for key, high in sorted(end.items()):
            low = start.get(key, self._begin(key) if key in self.zones else high)
            if high > low:
                topic, partition = key.rsplit("/", 1)
                spans.append(Span(topic, int(partition), low, high, [f for least, greatest, f in sorted(self.zones[key]) if least < high and greatest >= low]))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        system, root = _open(self.path)
        wanted = [("offset", ">=", partition.low), ("offset", "<", partition.high)]
        # at most ``records`` offsets: held and put in order here, whatever order the files have
        found = [pq.read_table(f"{root}/{f}", filesystem=system, columns=["key", "value", "offset", "timestamp"], filters=wanted, partitioning=None) for f in partition.files]
        if not found:
            return
        rows = pa.concat_tables(found).sort_by("offset")
        rows = rows.append_column("topic", pa.array([partition.topic] * len(rows), pa.string())).append_column("partition", pa.array([partition.partition] * len(rows), pa.int32()))
        stamps = rows.column("timestamp")
        rows = rows.set_column(rows.schema.get_field_index("timestamp"), "timestamp", pc.cast(stamps, pa.timestamp("us")))
        yield from rows.select(_ARROW.names).cast(_ARROW).to_batches(max_chunksize=10_000)


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return LOG_SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return LogStreamReader(self.options)


def read_log_polls(
    spark: SparkSession, path: str, records: int = MAX_RECORDS_PER_POLL, partitions: list[int] | None = None, topic: str | None = None, start_offsets: DataFrame | None = None,
) -> DataFrame:
    """The stream; ``start_offsets`` (topic, partition, start_offset) has a row per partition and is read now."""
    ship_package(spark)
    spark.dataSource.register(LogSource)
    reader = spark.readStream.format(NAME).option("path", path).option("records", str(records))
    if partitions is not None:
        reader = reader.option("partitions", ",".join(str(int(p)) for p in partitions))
    if topic is not None:
        reader = reader.option("topic", topic)
    if start_offsets is not None:
        starts = start_offsets.where("topic is not null and partition is not null and start_offset is not null").collect()
        reader = reader.option("starts", json.dumps({f"{r['topic']}/{r['partition']}": int(r["start_offset"]) for r in starts}))
    return reader.load()
