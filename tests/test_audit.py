"""Audits: block sums find what differs and nothing else; completed intervals with retries, overlaps and holes."""

import random

from pyspark.sql import functions as F

from ledgerline.operators.audit import audit_missing, completion_frontier, differing_blocks, missing_ranges
from ledgerline.schema import SINK_SCHEMA

LOG = "key string, topic string, partition int, offset long"


def log_of(spark, n=30_000):
    i = F.col("id")
    part = F.when(i % 5 < 2, 0).otherwise(i % 3 + 1).cast("int")
    return spark.range(n).select(F.concat(F.lit("k"), i.cast("string")).alias("key"), F.lit("t").alias("topic"), part.alias("partition"), i.alias("offset"))


def sink_of(log):
    return log.select(F.col("key").alias("id"), F.lit("{}").alias("post_json"), "topic", F.col("partition").cast("long").alias("topic_partition"), F.col("offset").alias("partition_offset"), F.lit(0).cast("long").alias("batch_id"))


def test_nothing_is_opened_or_kept_where_log_and_table_agree(spark):
    log = log_of(spark)
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert differing_blocks(log, log).count() == 0
    assert audit_missing(log, sink_of(log)).count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached


def test_only_blocks_that_differ_are_opened(spark):
    log = log_of(spark)
    gone = F.col("offset").isin(5, 12_345, 29_999)
    assert {r["block"] for r in differing_blocks(log.select("topic", "partition", "offset"), log.where(~gone).select("topic", "partition", "offset")).collect()} == {0, 12_345 // 1_024, 29_999 // 1_024}
    for block in (1, 7, 1_024):
        got = audit_missing(log, sink_of(log.where(~gone)), block=block).collect()
        assert sorted(r["offset"] for r in got) == [5, 12_345, 29_999] and not any(r["key_stored"] for r in got)


def test_keys_stored_elsewhere_and_odd_records(spark):
    log = spark.createDataFrame([("a", "t", 0, 0), ("a", "t", 0, 1), (None, "t", 0, 2), ("b", "t", None, 3), ("c", None, 1, 4), ("d", "t", 1, None), ("e", "t", 1, -7)], LOG)
    sink = spark.createDataFrame([("a", "{}", "t", 0, 0, 0), ("c", "{}", "t", 9, 9, 0), ("z", None, None, None, None, 0)], SINK_SCHEMA)
    got = {(r["key"], r["offset"]): r["key_stored"] for r in audit_missing(log, sink).collect()}
    assert got == {("a", 1): True, (None, 2): False, ("b", 3): False, ("c", 4): True, ("d", None): False, ("e", -7): False}
    assert audit_missing(log.limit(0), sink).count() == 0 and audit_missing(log, sink.limit(0)).count() == 7


def test_frontier_and_holes_against_a_plain_union(spark):
    rng = random.Random(1)
    rows, covered = [], {}
    for _ in range(3_000):
        p = 0 if rng.random() < 0.6 else rng.randrange(1, 4)
        lo = rng.randrange(0, 6_000)
        hi = lo + rng.choice([1, 1, 2, 5, 40])
        rows += [("t", p, lo, hi)] * rng.choice([1, 1, 3])
        covered.setdefault(p, set()).update(range(lo, hi))
    rows += [("t", 7, 0, 10), ("t", 7, 10, 20), ("t", 8, 4, 4), ("t", 9, None, 5), (None, 0, 0, 9_999), ("t", 10, 3, 5), ("t", 11, 0, 100_000), ("t", 11, 50, 60), ("t", 11, 100_001, 100_002)]
    covered |= {7: set(range(20)), 10: {3, 4}, 11: set(range(100_000)) | {100_001}}
    done = spark.createDataFrame(rows, "topic string, partition int, lo long, hi long")
    for parts in (1, 8):
        front = {r["partition"]: tuple(r)[2:] for r in completion_frontier(done, num_partitions=parts).collect()}
        holes = {}
        for r in missing_ranges(done, num_partitions=parts).collect():
            holes.setdefault(r["partition"], set()).update(range(r["lo"], r["hi"]))
        assert set(front) == set(covered)
        for p, have in covered.items():
            gone = set(range(max(have))) - have
            assert holes.get(p, set()) == gone
            n_gaps = sum(1 for g in gone if g - 1 not in gone)
            assert front[p] == (min(gone, default=max(have) + 1), max(have) + 1, n_gaps, len(gone))
    late = {r["partition"]: r["frontier"] for r in completion_frontier(done, start=5).collect()}
    assert late[10] == 5 and late[7] == 20
