"""Zone map of a stored log: per file its (topic, partition) and offset range, beside the log in ``_zones``.

:func:`ledgerline.sources.log.write_log` adds a row for every file that it writes. A seek opens only the files that
reach its start, partition by partition, whether or not the seek names every partition; the offset-addressed stream
source plans its reads with it. Files that have no row (written by others) are always read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import LOG_SCHEMA
from ..session import path_exists

FOLDER = "_zones"
ZONE_SCHEMA = "file string, topic string, partition int, least long, greatest long, records long, unplaced long"
#: A file's place below the log's folder.
_BELOW = r"(topic=[^/]*/partition=[^/]*/[^/]+)$"


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """(file, topic, partition, least, greatest, records, unplaced): ``unplaced`` counts records without an offset."""
    at = f"{path.rstrip('/')}/{FOLDER}"
    return spark.read.schema(ZONE_SCHEMA).parquet(at) if path_exists(spark, at) else spark.createDataFrame([], ZONE_SCHEMA)


def _below(file: str) -> str:
    return "/".join(file.rsplit("/", 3)[1:])


def log_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a stored log, as places below its folder (the listing that every scan makes)."""
    return [_below(f) for f in spark.read.schema(LOG_SCHEMA).parquet(path).inputFiles()]


def read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    reader = spark.read.schema(LOG_SCHEMA).option("basePath", path)
    return reader.parquet(*[f"{path.rstrip('/')}/{f}" for f in files])


def add_zones(spark: SparkSession, path: str) -> int:
    """Rows for the files that have none yet; reads their offsets only. Returns how many there were."""
    known = {r["file"] for r in read_zones(spark, path).select("file").toLocalIterator()}
    new = [f for f in log_files(spark, path) if f not in known]
    if new:
        rows = read_files(spark, path, new).select(F.regexp_extract("_metadata.file_path", _BELOW, 1).alias("file"), "topic", "partition", "offset")
        zones = rows.groupBy("file", "topic", "partition").agg(
            F.min("offset").alias("least"), F.max("offset").alias("greatest"), F.count(F.lit(1)).alias("records"), F.count_if(F.col("offset").isNull()).alias("unplaced"))
        # one row a file: few, whatever the records
        zones.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/{FOLDER}")
    return len(new)


@dataclass
class Reach:
    """Files of a seek: read ``whole``, or in ``part`` (a start falls inside, or nothing is known of the file);
    ``skipped`` files end before their partition's start."""

    whole: list[str]
    part: list[str]
    skipped: list[str]


def reach(spark: SparkSession, path: str, starts: DataFrame) -> Reach:
    """Which files hold records at or after ``starts`` (topic, partition, _start), unlisted partitions whole."""
    files = set(log_files(spark, path))
    zones = read_zones(spark, path).alias("z")
    at = F.broadcast(starts.alias("s"))  # a row per partition of the log
    met = zones.join(at, (F.col("z.topic") == F.col("s.topic")) & (F.col("z.partition") == F.col("s.partition")), "left")
    state = (
        F.when(F.col("_start").isNull() | ((F.col("unplaced") == 0) & (F.col("least") >= F.col("_start"))), "whole")
        .when((F.col("unplaced") == 0) & (F.col("greatest") < F.col("_start")), "skipped").otherwise("part")
    )
    found = {r["file"]: r["state"] for r in met.select("file", state.alias("state")).toLocalIterator() if r["file"] in files}
    lists: dict[str, list[str]] = {"whole": [], "part": [], "skipped": []}
    for f in sorted(files):
        lists[found.get(f, "part")].append(f)
    return Reach(**lists)
