"""The zone map and the offset-addressed stream source: files skipped, bounded polls, restarts, assigned partitions."""

import pytest
from pyspark.sql import functions as F

from ledgerline.schema import LOG_SCHEMA
from ledgerline.session import scratch_path
from ledgerline.sources.log import after_starts, read_log, start_map, write_log
from ledgerline.sources.offsets import read_log_polls
from ledgerline.sources.zones import log_files, reach, read_zones
from ledgerline.streaming.runs import drain_polls, run_foreach

STARTS = "topic string, partition int, start_offset long"


def records(spark, lo, hi, parts=4, topic="t"):
    n = F.col("id")
    return spark.range(lo, hi).select(
        n.cast("string").alias("key"), F.concat(F.lit("v"), n.cast("string")).alias("value"), F.lit(topic).alias("topic"), (n % parts).cast("int").alias("partition"),
        F.floor(n / parts).cast("long").alias("offset"), F.lit(None).cast("timestamp_ntz").alias("timestamp"))


@pytest.fixture
def log_path(spark):
    """Three appends of 100 offsets of each of four partitions: a file per append and partition."""
    path = scratch_path(spark, "tests", "log")
    for k in range(3):
        write_log(records(spark, 400 * k, 400 * k + 400).coalesce(1), path, mode="append", prepartitioned=True)
    return path


def test_a_seek_opens_only_the_files_it_reaches(spark, log_path):
    assert read_zones(spark, log_path).count() == len(log_files(spark, log_path)) == 12
    # partitions 0 and 1 are listed, 2 and 3 are not: those are read whole, and the listed ones from their start on
    starts = spark.createDataFrame([("t", 0, 150), ("t", 1, 200), ("other", 2, 10**6), ("t", None, 5)], STARTS)
    found = reach(spark, log_path, start_map(starts))
    assert (len(found.skipped), len(found.part), len(found.whole)) == (3, 1, 8)
    assert all("partition=0" in f or "partition=1" in f for f in found.skipped)
    got = read_log(spark, log_path, start_offsets=starts)
    want = after_starts(read_log(spark, log_path), start_map(starts))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 150 + 100 + 600
    assert read_log(spark, log_path, partitions=[1], start_offsets=starts).count() == 100
    beyond = spark.createDataFrame([("t", p, 300) for p in range(4)], STARTS)
    assert read_log(spark, log_path, start_offsets=beyond).count() == 0


def test_files_without_a_zone_and_records_without_an_offset_are_read(spark, log_path):
    odd = [("n", None, "t", 0, None, None), ("m", None, "t", 0, 5, None)]
    spark.createDataFrame(odd, LOG_SCHEMA).coalesce(1).write.mode("append").partitionBy("topic", "partition").parquet(log_path)  # not by write_log
    starts = spark.createDataFrame([("t", p, 300) for p in range(4)], STARTS)
    assert [r["key"] for r in read_log(spark, log_path, start_offsets=starts).collect()] == ["n"]
    write_log(spark.createDataFrame([("z", None, "t", 1, 300, None)], LOG_SCHEMA), log_path, mode="append")  # lists the other file too
    zones = read_zones(spark, log_path)
    assert zones.count() == len(log_files(spark, log_path)) and zones.where("unplaced = 1").count() == 1
    assert sorted(r["key"] for r in read_log(spark, log_path, start_offsets=starts).collect()) == ["n", "z"]


def polled(spark, path, ckpt, seen, fail_at=None, **how):
    def keep(batch, batch_id):
        rows = [(r["partition"], r["offset"], r["key"], r["value"], r["topic"]) for r in batch.collect()]
        if batch_id == fail_at:
            raise RuntimeError("injected")
        seen.append((batch_id, rows))

    drain_polls(run_foreach(read_log_polls(spark, path, **how), keep, ckpt, available_now=False))


def test_a_backlog_comes_in_bounded_ordered_polls_and_goes_on_after_a_failure(spark, log_path, scratch):
    ckpt, seen = scratch("ckpt"), []
    with pytest.raises(Exception):
        polled(spark, log_path, ckpt, seen, fail_at=2, records=70)
    assert [b for b, _ in seen] == [0, 1]
    polled(spark, log_path, ckpt, seen, records=70)  # the failed poll again, then the rest
    assert [b for b, _ in seen] == [0, 1, 2, 3, 4]
    for b, rows in seen:
        for p in range(4):
            mine = [r for r in rows if r[0] == p]
            assert [r[1] for r in mine] == list(range(70 * b, min(70 * b + 70, 300)))
            assert all(r[2:] == (str(4 * r[1] + p), f"v{4 * r[1] + p}", "t") for r in mine)
    # an append, and a partition that was not there before
    write_log(records(spark, 1200, 1240), log_path, mode="append")
    write_log(spark.createDataFrame([("new", None, "t", 9, 7, None)], LOG_SCHEMA), log_path, mode="append")
    polled(spark, log_path, ckpt, seen, records=70)
    assert len(seen) == 6 and sorted(r[1] for r in seen[-1][1]) == [7] + sorted(list(range(300, 310)) * 4)
    polled(spark, log_path, ckpt, seen, records=70)  # nothing new
    assert len(seen) == 6


def test_assigned_partitions_start_where_they_are_told(spark, log_path, scratch):
    seen = []
    starts = spark.createDataFrame([("t", 1, 290), ("t", 2, 0), ("t", 3, 500)], STARTS)
    polled(spark, log_path, scratch("ckpt"), seen, records=200, partitions=[1, 2, 3], start_offsets=starts)
    got = [(p, o) for _, rows in seen for p, o, *_ in rows]
    assert got.count((1, 290)) == 1 and sorted(got) == [(1, o) for o in range(290, 300)] + [(2, o) for o in range(300)]
    none = []
    polled(spark, log_path, scratch("ckpt"), none, topic="absent")
    assert not any(rows for _, rows in none)
