"""The result table: what a look-up opens, crashes, replays, compaction, sketches and row groups."""

import glob
import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import ledgerline.operators.table as table_mod
from ledgerline.functions.codec import decode_posts
from ledgerline.operators.ledger import starts_from_sink
from ledgerline.operators.projections import for_partition
from ledgerline.operators.sink import first_success_per_key, read_sink, write_sink_batch
from ledgerline.operators.table import ResultTable
from ledgerline.sources.log import stored_log
from conftest import SF001


def rows(spark, lo, hi, parts=20):
    n = F.col("id")
    return spark.range(lo, hi).select(
        n.cast("string").alias("id"), F.concat(F.lit("{"), n.cast("string"), F.lit("}")).alias("post_json"), F.lit("posts").alias("topic"),
        (n % parts).alias("topic_partition"), n.alias("partition_offset"))


def ids(df):
    return sorted(int(r[0]) for r in df.select("id").collect())


def local(path):
    return re.sub("^file:", "", path)


def test_only_folders_that_may_hold_a_key_are_opened(spark, scratch):
    table = ResultTable.create(spark, scratch("table"))
    for k in range(4):
        table.append(rows(spark, 1000 * k, 1000 * k + 1000), k)
    assert len(table.manifest().parts) == 4 * table_mod.BUCKETS
    # nothing stored: no id is read
    new = table.new_rows(rows(spark, 50_000, 50_400))
    assert ids(new) == list(range(50_000, 50_400))
    assert table.probed["opened"] <= 8 and table.probed["maybe"] <= 8  # false hits are rare
    # three stored keys: three folders at most, beside false hits
    new = table.new_rows(rows(spark, 2_997, 3_003).where("partition_offset <= 3000 or partition_offset >= 4000"))
    assert ids(new) == [] and table.probed["opened"] <= 4 < table.probed["parts"]
    mixed = rows(spark, 3_900, 4_100)
    assert ids(table.new_rows(mixed)) == list(range(4_000, 4_100))
    assert ids(table.new_rows(mixed, max_rows=0)) == list(range(4_000, 4_100))  # without a broadcast
    assert ids(table.lookup(["17", "2500", "99999"])) == [17, 2500]


def test_keys_that_repeat_and_null_keys(spark, scratch):
    table = ResultTable.create(spark, scratch("table"))
    table.append(rows(spark, 0, 100), 0)
    batch = spark.createDataFrame([("5",), ("5",), ("500",), ("500",), (None,)], "key string")
    assert sorted(str(r[0]) for r in table.new_rows(batch, key_col="key").collect()) == ["500", "500", "None"]
    assert table.new_rows(batch.limit(0), key_col="key").count() == 0


def test_a_crash_before_the_commit_leaves_the_old_table(spark, scratch, monkeypatch):
    table = ResultTable.create(spark, scratch("table"))
    table.append(rows(spark, 0, 300), 0)
    before = table.manifest()

    def crash(self, manifest):
        raise RuntimeError("crash between write and manifest")

    with monkeypatch.context() as m:
        m.setattr(ResultTable, "_commit", crash)
        with pytest.raises(RuntimeError):
            table.append(rows(spark, 300, 600), 1)
    assert table.manifest() == before and ids(table.read()) == list(range(300))
    assert not table.holds(1)
    assert table.append(rows(spark, 300, 600), 1) and table.holds(1)
    assert not table.append(rows(spark, 300, 600), 1)  # runs again: stored already
    assert ids(table.read()) == list(range(600))
    assert table.vacuum() == 1  # what the crash left
    assert ids(table.read()) == list(range(600))


def test_a_second_writer_is_refused(spark, scratch):
    path = scratch("table")
    ResultTable.create(spark, path)
    one, other = ResultTable(spark, path), ResultTable(spark, path)
    stale = other.manifest()
    one.append(rows(spark, 0, 10), 0)
    other.manifest = lambda: stale
    with pytest.raises(Exception, match="exists"):
        other.append(rows(spark, 10, 20), 0)
    assert ids(one.read()) == list(range(10))


def test_compaction_merges_rows_and_sketches(spark, scratch):
    table = ResultTable.create(spark, scratch("table"), buckets=4)
    for k in range(9):
        table.append(rows(spark, 100 * k, 100 * k + 100), k)
        reader = table.read()
        table.compact(fan_in=3)
        assert reader.count() == 100 * (k + 1)  # a reader keeps the version that it began with
    now = table.manifest()
    assert len(now.parts) < 4 * 9 and sum(p[2] for p in now.parts) == 900
    assert ids(table.read()) == list(range(900))
    assert sorted(r[0] for r in table.read().select("batch_id").distinct().collect()) == list(range(9))
    assert ids(table.new_rows(rows(spark, 850, 950))) == list(range(900, 950))
    # merged bitmaps are what the merged rows' bitmaps would be
    whole = ResultTable.create(spark, scratch("whole"), buckets=4)
    whole.append(rows(spark, 0, 900), 0)

    def bits(t):
        s = t._sketches(t.manifest(), t.manifest().parts).groupBy("bucket", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))
        return {(r["bucket"], r["slot"]): bytes(r["bits"]) for r in s.collect()}

    assert bits(table) == bits(whole)
    assert table.vacuum(versions=1) > 0 and ids(table.read()) == list(range(900))


def test_versions_are_kept_few(spark, scratch, monkeypatch):
    monkeypatch.setattr(table_mod, "VERSIONS", 3)
    table = ResultTable.create(spark, scratch("table"), buckets=1)
    for k in range(5):
        table.append(rows(spark, k, k + 1), k)
    assert len(table._versions()) == 3 and ids(table.read()) == list(range(5))


def test_progress_comes_from_the_manifest(spark, scratch):
    path = scratch("sink")
    log = stored_log(spark, SF001)
    for k, part in enumerate((F.col("offset") < 20, F.col("offset") >= 20)):
        write_sink_batch(first_success_per_key(decode_posts(log.where(part))), path, k)
    got = {tuple(r) for r in ResultTable(spark, path).starts().collect()}
    assert got == {tuple(r) for r in starts_from_sink(read_sink(spark, path)).collect()} and got
    exclusive = {tuple(r) for r in ResultTable(spark, path).starts(inclusive=False).collect()}
    assert exclusive == {(t, p, o + 1) for t, p, o in got}


def test_row_groups_of_a_partition_and_of_a_key(spark, scratch, monkeypatch):
    monkeypatch.setattr(table_mod, "ROW_GROUP_BYTES", 4_096)
    path = scratch("table")
    table = ResultTable.create(spark, path, buckets=2)
    table.append(rows(spark, 0, 30_000), 0)
    groups = [g for f in glob.glob(f"{local(path)}/data/*/rows/**/*.parquet", recursive=True) for m in [pq.ParquetFile(f).metadata] for g in (m.row_group(k) for k in range(m.num_row_groups))]
    assert len(groups) > 60

    def met(column, value):
        at = next(k for k in range(groups[0].num_columns) if groups[0].column(k).path_in_schema == column)
        stats = [g.column(at).statistics for g in groups]
        return sum(s.min <= value <= s.max for s in stats) / len(groups)

    assert met("topic_partition", 7) < 1 / 3
    h = spark.sql("select xxhash64('777')").first()[0]
    assert met("id_hash", h) < 0.5  # both buckets' groups are counted
    found = for_partition(read_sink(spark, path), "posts", 7)
    assert ids(found) == list(range(7, 30_000, 20))


def test_odd_rows_are_stored(spark, scratch):
    path = scratch("table")
    odd = spark.createDataFrame([("a", None, None, None, None), ("ü" * 50_000, "x", "t", 3, None), ("b", "y", "t", -1, -5), ("", "z", "t", 2**40, 2**60)], "id string, post_json string, topic string, topic_partition long, partition_offset long")
    write_sink_batch(odd, path, 0)
    assert read_sink(spark, path).drop("batch_id").exceptAll(odd).count() == 0
    assert ResultTable(spark, path).new_rows(odd).count() == 0
    assert json.dumps(ResultTable(spark, path).manifest().progress) == '[["t", -1, -5], ["t", 1099511627776, 1152921504606846976]]'
