"""Operators on a log where one key (and one partition) holds more than a third of all records."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.functions.codec import decode_posts
from ledgerline.operators.audit import audit_duplicates
from ledgerline.operators.ledger import commit_ledger
from ledgerline.operators.sink import first_success_per_key


def _skewed_log(spark, n=6000):
    ids = spark.range(n)
    hot = F.col("id") % 5 < 2  # 40% of records carry key "hot"
    key = F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string"))
    part = F.when(hot, F.lit(0)).otherwise((F.col("id") % 7).cast("int"))
    # the hot key's early copies are malformed: the first *storable* one must win
    value = F.when(hot & (F.col("id") < 100), F.lit("{bad")).otherwise(
        F.to_json(F.struct(key.alias("id"), F.col("id").cast("string").alias("text")))
    )
    log = ids.select(key.alias("key"), value.alias("value"), F.lit("t").alias("topic"), part.alias("partition"), F.col("id"))
    w = Window.partitionBy("partition").orderBy("id")
    return log.withColumn("offset", F.row_number().over(w) - 1).drop("id").repartition(8)


def test_first_success_under_a_hot_key(spark):
    log = _skewed_log(spark)
    got = first_success_per_key(decode_posts(log))
    ok = decode_posts(log).where(F.col("decode_status").isin("ok", "skip"))
    w = Window.partitionBy("key").orderBy("partition", "offset")
    want = ok.withColumn("rn", F.row_number().over(w)).where("rn = 1").select(
        F.col("key").alias("id"), F.col("value").alias("post_json"), "topic",
        F.col("partition").cast("long").alias("topic_partition"), F.col("offset").alias("partition_offset"),
    )
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    hot = got.where("id = 'hot'").first()
    # hot copies from ids below 100 are malformed: the first storable copy is the one from id 100
    assert hot["topic_partition"] == 0 and '"text":"100"' in hot["post_json"]


def test_ledger_and_audit_under_a_hot_partition(spark):
    log = _skewed_log(spark)
    ledger = {r["partition"]: r["next_offset"] for r in commit_ledger(log).collect()}
    sizes = {r["partition"]: r["count"] for r in log.groupBy("partition").count().collect()}
    assert ledger == sizes
    dup = audit_duplicates(log, ["key"]).collect()
    assert [(r["key"], r["copies"]) for r in dup] == [("hot", 2400)]


def test_audit_missing_under_a_hot_key(spark):
    from ledgerline.operators.audit import audit_missing

    log = _skewed_log(spark)
    sink = first_success_per_key(decode_posts(log))
    missing = audit_missing(log, sink)
    assert missing.count() == log.count() - sink.count()
    hot = missing.where("key = 'hot'")
    assert hot.count() == 2399 and hot.where("key_stored").count() == 2399


def test_new_ids_fallback_path_under_a_hot_key(spark):
    from ledgerline.operators.sink import new_ids

    log = _skewed_log(spark)
    stored = first_success_per_key(decode_posts(log.where("offset < 100")))
    later = log.where("offset >= 100")
    fast = new_ids(later, stored, key_col="key")
    slow = new_ids(later, stored, key_col="key", max_rows=10)  # forces the no-broadcast path
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    assert fast.where("key = 'hot'").count() == 0  # the hot key was stored early
