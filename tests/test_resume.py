"""Resume positions (fixture L4), seek pushdown and partition pruning."""

from pyspark.sql import functions as F

from ledgerline.operators.ledger import resume_from_ledger, resume_from_sink, sink_max_offset
from ledgerline.plans.inspect import scan_filters
from ledgerline.schema import SINK_SCHEMA
from ledgerline.sources.log import read_log, stored_log, stored_log_path
from conftest import SF001


def _first_offsets(df):
    return {r["partition"]: r["first"] for r in df.groupBy("partition").agg(F.min("offset").alias("first")).collect()}


def _sink(spark, rows):
    return spark.createDataFrame(rows, SINK_SCHEMA)


def test_empty_sink_starts_at_zero(spark):
    log = stored_log(spark, SF001)
    firsts = _first_offsets(resume_from_sink(log, _sink(spark, [])))
    assert set(firsts.values()) == {0}


def test_inclusive_resume_from_sink_and_missing_partition(spark):
    log = stored_log(spark, SF001)
    sink = _sink(spark, [("a", "{}", "posts", 3, 41, 0), ("b", "{}", "posts", 3, 12, 0)])
    firsts = _first_offsets(resume_from_sink(log, sink))
    assert firsts[3] == 41
    assert all(v == 0 for p, v in firsts.items() if p != 3)


def test_exclusive_resume_from_ledger(spark):
    log = stored_log(spark, SF001)
    ledger = spark.createDataFrame([("posts", 5, 42)], "topic string, partition int, next_offset long")
    firsts = _first_offsets(resume_from_ledger(log, ledger))
    assert firsts.get(5, 42) == 42 or 5 not in firsts
    assert all(v == 0 for p, v in firsts.items() if p != 5)


def test_sink_max_offset_fills_zero(spark):
    parts = spark.createDataFrame([("posts", 1), ("posts", 2)], "topic string, partition int")
    sink = _sink(spark, [("a", "{}", "posts", 1, 7, 0)])
    got = {r["partition"]: r["max_offset"] for r in sink_max_offset(sink, parts).collect()}
    assert got == {1: 7, 2: 0}


def test_assigned_scan_prunes_partitions(spark):
    df = read_log(spark, stored_log_path(spark, SF001), partitions=[3, 7])
    filters = scan_filters(df)
    assert any("partition" in f and "3" in f for f in filters["PartitionFilters"])
    assert {r[0] for r in df.select("partition").distinct().collect()} == {3, 7}


def test_offset_predicate_is_pushed_and_columns_pruned(spark):
    df = read_log(spark, stored_log_path(spark, SF001)).where(F.col("offset") >= 30).select("key", "offset")
    filters = scan_filters(df)
    assert any("offset" in f for f in filters["PushedFilters"])
    assert all("value" not in s for s in filters["ReadSchema"])


STARTS = "topic string, partition int, start_offset long"


def test_full_seek_map_pushes_the_lowest_start(spark):
    path = stored_log_path(spark, SF001)
    parts = sorted(r[0] for r in read_log(spark, path).select("partition").distinct().collect())
    starts = spark.createDataFrame([("posts", p, 10 + p) for p in parts], STARTS)
    got = read_log(spark, path, start_offsets=starts)
    assert any(f"GreaterThanOrEqual(offset,{10 + parts[0]})" in f for f in scan_filters(got)["PushedFilters"])
    want = read_log(spark, path).where(F.col("offset") >= 10 + F.col("partition"))
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_seek_keeps_what_is_not_listed(spark):
    """One rule for few and many listed partitions, through a broadcast or a shuffle join: null topics and
    partitions, null starts and negative offsets of unlisted partitions stay."""
    import ledgerline.sources.log as log_mod
    from ledgerline.schema import LOG_SCHEMA

    rows = [("a", None, "posts", 1, 4, None), ("b", None, "posts", 1, 5, None), ("c", None, "posts", None, 0, None),
            ("d", None, None, 1, 0, None), ("e", None, "posts", 2, -3, None), ("f", None, "posts", 9, 0, None)]
    log = spark.createDataFrame(rows, LOG_SCHEMA)
    few = [("posts", 1, 5), ("posts", 9, None), (None, None, 100)]
    many = few + [("posts", p, 7) for p in range(1000, 3000)]
    for starts in (few, many):
        got = log_mod.seek(log, spark.createDataFrame(starts, STARTS))
        assert sorted(r["key"] for r in got.collect()) == ["b", "c", "d", "e", "f"]


def test_partition_predicate_on_sink_is_pushed(spark, scratch):
    from ledgerline.functions.codec import decode_posts
    from ledgerline.operators.projections import for_partition
    from ledgerline.operators.sink import first_success_per_key, read_sink, write_sink_batch

    path = scratch("sink")
    write_sink_batch(first_success_per_key(decode_posts(stored_log(spark, SF001))), path, 0)
    rows = for_partition(read_sink(spark, path), "posts", 7)
    pushed = " ".join(scan_filters(rows)["PushedFilters"])
    assert "EqualTo(topic_partition,7)" in pushed and "EqualTo(topic,posts)" in pushed
    assert {r[0] for r in rows.select("topic_partition").distinct().collect()} == {7}


def test_seek_without_broadcast_gives_the_same_rows(spark, monkeypatch):
    import ledgerline.operators.joins as joins
    import ledgerline.sources.log as log_mod

    starts = spark.createDataFrame([("posts", 3, 10), ("posts", 4, 0), ("posts", 9, 7)], STARTS)
    main = log_mod.seek(stored_log(spark, SF001), starts)
    monkeypatch.setattr(log_mod, "join_bounded", lambda *a, **k: joins.join_bounded(*a, **{**k, "max_rows": 0}))
    other = log_mod.seek(stored_log(spark, SF001), starts)
    assert main.exceptAll(other).count() == 0 and other.exceptAll(main).count() == 0
