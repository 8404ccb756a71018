"""In-order processing (O1), per-partition functions (O3), producer columns, plan description."""

import re

from pyspark.sql import functions as F

from ledgerline.functions.columns import labelled, new_key, random_index, stable_key
from ledgerline.operators.ordering import in_partition_order, per_partition
from ledgerline.operators.sink import first_success_per_key
from ledgerline.functions.codec import decode_posts
from ledgerline.plans.inspect import plan_text
from ledgerline.sources.log import stored_log
from ledgerline.streaming.runs import describe
from conftest import SF001


def test_in_partition_order_sees_ascending_offsets(spark):
    def _check_order(frames):
        import pandas as pd

        for pdf in frames:
            prev = {}
            ok = True
            for p, o in zip(pdf["partition"], pdf["offset"]):
                if p in prev and o <= prev[p]:
                    ok = False
                prev[p] = o
            yield pd.DataFrame({"rows": [len(pdf)], "ordered": [ok]})

    log = stored_log(spark, SF001).repartition(7)  # scramble first
    out = in_partition_order(log, _check_order, "rows long, ordered boolean", num_partitions=5).collect()
    assert all(r["ordered"] for r in out)
    assert sum(r["rows"] for r in out) == log.count()


def test_per_partition_partials_combine(spark):
    def _count_chunk(frames):
        for pdf in frames:
            yield pdf.groupby(["topic", "partition"]).size().rename("n").reset_index()

    log = stored_log(spark, SF001)
    parts = per_partition(log, _count_chunk, "topic string, partition int, n long")
    got = {r["partition"]: r["n"] for r in parts.groupBy("partition").agg(F.sum("n").alias("n")).collect()}
    want = {r["partition"]: r["count"] for r in log.groupBy("partition").count().collect()}
    assert got == want


def test_producer_columns(spark):
    df = spark.range(50).select(
        new_key().alias("k"), stable_key("id").alias("s"), random_index(7).alias("r"), labelled("author", F.col("id")).alias("a")
    )
    rows = df.collect()
    assert len({r["k"] for r in rows}) == 50
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", r["s"]) for r in rows)
    assert all(-(2**31) <= r["r"] < 2**31 for r in rows)
    assert rows[3]["a"] == "author3"


def test_first_success_is_a_partial_aggregate(spark):
    plan = plan_text(first_success_per_key(decode_posts(stored_log(spark, SF001))))
    assert "partial_min" in plan
    assert "Window" not in plan


def test_describe_stream_plan(spark, scratch):
    from ledgerline.sources.log import read_log_stream, stored_log_path

    text = describe(read_log_stream(spark, "table", path=stored_log_path(spark, SF001)).select("key", "value"))
    assert "key" in text and "value" in text


def test_partition_lanes_see_whole_partitions_in_order(spark):
    def _lanes(frames):
        import pandas as pd

        seen = {}
        ok = True
        for pdf in frames:
            for p, o in zip(pdf["partition"], pdf["offset"]):
                if p in seen and o != seen[p] + 1:
                    ok = False
                seen[p] = o
        yield pd.DataFrame({"partition": list(seen), "last": list(seen.values()), "ok": [ok] * len(seen)})

    log = stored_log(spark, SF001).repartition(5)
    out = in_partition_order(log, _lanes, "partition int, last long, ok boolean", num_partitions=4, lanes="partition").collect()
    assert all(r["ok"] for r in out)
    assert len(out) == log.select("partition").distinct().count()  # each partition in exactly one lane


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from ledgerline.operators.joins import estimated_bytes, fits_broadcast, join_bounded

    small = spark.range(10).selectExpr("id", "cast(id as string) as s")
    assert estimated_bytes(small, 10) == 10 * (8 + 20)
    assert fits_broadcast(small, 10)
    assert not fits_broadcast(small, 10, max_rows=5)
    assert not fits_broadcast(small, 10**7)
    big = spark.range(100)
    previous = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # only our hint may broadcast here
    try:
        assert "BroadcastHashJoin" in plan_text(join_bounded(big, small, ["id"], rows=10))
        assert "BroadcastHashJoin" not in plan_text(join_bounded(big, small, ["id"], rows=10, max_bytes=100))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", previous)


def test_queries_leave_the_callers_session_settings_alone(spark):
    import __spark_entry__ as entry
    from conftest import SF001

    keys = ["spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for name in ("exactly_once_sink", "highest_offset_stream", "exactly_once_keyed"):
        entry.queries()[name](spark, SF001).count()
    assert {k: spark.conf.get(k, None) for k in keys} == before


def test_estimated_bytes_of_nested_types(spark):
    from ledgerline.operators.joins import estimated_bytes

    df = spark.createDataFrame(
        [], "a struct<x: int, y: string>, b array<long>, c map<string,int>, d decimal(30,2), e boolean, v variant"
    )
    # struct 4 + 20, array 100, map 100, wide decimal 16, boolean 1, variant 20
    assert estimated_bytes(df, 1) == 4 + 20 + 100 + 100 + 16 + 1 + 20
    assert estimated_bytes(df, 1000) == 1000 * 261


def test_argument_checks(spark):
    import pytest

    from ledgerline.functions.codec import decode_posts

    log = stored_log(spark, SF001)
    with pytest.raises(ValueError):
        decode_posts(log, on_error="ignore")
    with pytest.raises(ValueError):
        in_partition_order(log, lambda it: it, "x long", lanes="random")
