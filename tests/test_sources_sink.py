"""Sink initialisation, topic filters, stream seek maps."""

import pytest

from ledgerline.operators.sink import init_sink, read_sink, write_sink_batch
from ledgerline.schema import SINK_SCHEMA
from ledgerline.sources.log import read_log, stored_log_path
from conftest import SF001


def test_init_sink_reset_empties_a_used_sink(spark, scratch):
    path = scratch("sink")
    init_sink(spark, path)
    rows = spark.createDataFrame([("a", "{}", "posts", 1, 2)], "id string, post_json string, topic string, topic_partition long, partition_offset long")
    write_sink_batch(rows, path, 0)
    with pytest.raises(ValueError):
        init_sink(spark, path)
    assert init_sink(spark, path, reset=True).count() == 0
    # file sources read every column as nullable: compare names and types
    assert [(f.name, f.dataType) for f in read_sink(spark, path).schema] == [(f.name, f.dataType) for f in SINK_SCHEMA]


def test_topic_filter(spark):
    path = stored_log_path(spark, SF001)
    assert read_log(spark, path, topic="posts").count() == read_log(spark, path).count()
    assert read_log(spark, path, topic="other").count() == 0


def test_kafka_seek_map_becomes_starting_offsets(spark, monkeypatch):
    import ledgerline.sources.log as log_mod

    seen = {}

    def fake_options(**kw):
        seen.update(kw)
        raise RuntimeError("stop before connecting")

    monkeypatch.setattr("ledgerline.sources.kafka.kafka_options", fake_options)
    starts = spark.createDataFrame([("posts", 3, 41), ("posts", 5, 0)], "topic string, partition int, start_offset long")
    with pytest.raises(RuntimeError):
        log_mod.read_log_stream(spark, "kafka", topic="posts", partitions=[3, 5, 6], start_offsets=starts,
                                kafka={"bootstrap": "b:9092"})
    assert seen == {"bootstrap": "b:9092", "topic": "posts", "partitions": [3, 5, 6], "starting": {3: 41, 5: 0, 6: -2}}
    with pytest.raises(ValueError):  # a map of some partitions only
        log_mod.read_log_stream(spark, "kafka", topic="posts", start_offsets=starts, kafka={"bootstrap": "b:9092"})


def test_publish_appends_with_continuing_offsets(spark, scratch):
    from pyspark.sql import functions as F

    from ledgerline.operators.sink import publish

    path = scratch("topic")
    first = spark.range(0, 300).withColumnRenamed("id", "n")
    second = spark.range(300, 500).withColumnRenamed("id", "n")
    fields = {"id": F.col("n").cast("string"), "text": F.lit("x")}
    for part in (first, second):
        publish(part, fields, F.col("n"), "t", 4, path=path, order_by=("n",))
    log = read_log(spark, path)
    rows = log.select("key", "partition", "offset").collect()
    assert len(rows) == 500
    by_part = {}
    for r in rows:
        by_part.setdefault(r["partition"], []).append((r["offset"], int(r["key"])))
    for part, items in by_part.items():
        items.sort()
        assert [o for o, _ in items] == list(range(len(items)))  # dense, no gaps or repeats
        keys = [k for _, k in items]
        assert keys == sorted(keys)  # send order; the second publish continues after the first


def test_table_stream_tails_appends_and_seeks(spark, scratch):
    from pyspark.sql import functions as F

    from ledgerline.operators.sink import publish
    from ledgerline.sources.log import read_log_stream
    from ledgerline.streaming.runs import drain, run_foreach

    path, out, ckpt = scratch("topic"), scratch("out"), scratch("ckpt")
    fields = {"id": F.col("n").cast("string")}
    starts = spark.createDataFrame([("t", 0, 10)], "topic string, partition int, start_offset long")

    def keep(batch, batch_id):
        batch.select("partition", "offset").write.mode("append").parquet(out)

    for lo, hi in ((0, 100), (100, 160)):
        publish(spark.range(lo, hi).withColumnRenamed("id", "n"), fields, F.col("n"), "t", 2, path=path, order_by=("n",))
        drain(run_foreach(read_log_stream(spark, "table", path=path, start_offsets=starts), keep, ckpt))
    got = spark.read.parquet(out)
    log = read_log(spark, path)
    want = log.where(~((F.col("partition") == 0) & (F.col("offset") < 10))).select("partition", "offset")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_publish_append_without_broadcast(spark, scratch, monkeypatch):
    from pyspark.sql import functions as F

    import ledgerline.operators.joins as joins
    import ledgerline.operators.sink as sink_mod

    monkeypatch.setattr(sink_mod, "fits_broadcast", lambda *a, **k: False)
    monkeypatch.setattr(sink_mod, "join_bounded", lambda *a, **k: joins.join_bounded(*a, **{**k, "max_rows": 0}))
    path = scratch("topic")
    fields = {"id": F.col("n").cast("string")}
    for lo, hi in ((0, 120), (120, 200)):
        sink_mod.publish(spark.range(lo, hi).withColumnRenamed("id", "n"), fields, F.col("n"), "t", 3, path=path, order_by=("n",))
    rows = read_log(spark, path).select("partition", "offset", "key").collect()
    by_part = {}
    for r in rows:
        by_part.setdefault(r["partition"], []).append((r["offset"], int(r["key"])))
    assert sum(len(v) for v in by_part.values()) == 200
    for items in by_part.values():
        items.sort()
        assert [o for o, _ in items] == list(range(len(items)))
        assert [k for _, k in items] == sorted(k for _, k in items)


def _encoded_above_the_shuffle(log):
    plan = log._jdf.queryExecution().optimizedPlan().toString().lower()
    return 0 <= plan.find("json") < plan.find("repartition") and "json" not in plan[plan.find("repartition"):]


def test_records_are_encoded_in_their_ranges(spark, scratch, monkeypatch):
    """Rows are shuffled to their ranges as they are, not as the larger JSON."""
    from pyspark.sql import functions as F

    from ledgerline.operators import sink as sink_mod
    from ledgerline.sources import log as log_mod
    from ledgerline.sources.fixtures import derived_log, post_fields

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert _encoded_above_the_shuffle(derived_log(events))
    seen = []
    monkeypatch.setattr(log_mod, "write_log", lambda log, path, **how: seen.append(log))
    sink_mod.publish(events, post_fields(events), F.col("event_id"), "posts", 20, path=scratch("published"))
    assert _encoded_above_the_shuffle(seen[0])
