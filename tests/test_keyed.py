"""Effectively-once table through the keyed state index: equals the batch result, survives a crash, continues a table."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.codec import decode_posts
from ledgerline.operators.audit import audit_duplicates
from ledgerline.operators.sink import first_success_per_key, read_sink
from ledgerline.sources.log import read_log, read_log_stream, stored_log, write_log
from ledgerline.streaming.keyed import StoredIds, keyed_state_session, run_exactly_once_keyed
from ledgerline.streaming.runs import drain, resume_point, run_exactly_once
from conftest import SF001, write_poll_files


@pytest.fixture(scope="module")
def polls(spark):
    from ledgerline.session import scratch_path

    path = scratch_path(spark, "tests", "keyed-polls")
    write_poll_files(stored_log(spark, SF001), path, records_per_file=30)
    return path


def _run(spark, polls, sink, ckpt, **how):
    ks = keyed_state_session(spark, 2)
    stream = read_log_stream(ks, "files", path=polls, max_files_per_trigger=1)
    drain(run_exactly_once_keyed(stream, sink, ckpt, buckets=16, **how))


def _same(got, want):
    got = got.drop("batch_id")
    assert got.count() == want.count() and got.exceptAll(want).count() == 0
    assert audit_duplicates(got, ["id"], "partition_offset").count() == 0


def crash_once(marker):
    class CrashOnce(StoredIds):  # a class of the test's own goes to the workers by value
        """Fails the first time a batch brings a record from offset 60 on (a later micro-batch)."""

        def handleInputRows(self, key, rows, timerValues):
            rows = list(rows)
            if not os.path.exists(marker) and any((pdf["offset"] >= 60).any() for pdf in rows):
                open(marker, "w").close()
                raise RuntimeError("injected crash")
            yield from StoredIds.handleInputRows(self, key, iter(rows), timerValues)

    return CrashOnce()


def test_keyed_equals_batch_and_survives_a_crash(spark, scratch, polls):
    marker = os.path.join(tempfile.mkdtemp(prefix="ledgerline-crash-"), "crashed")
    sink, ckpt = scratch("sink"), scratch("ckpt")
    with pytest.raises(Exception):
        _run(spark, polls, sink, ckpt, processor=crash_once(marker))
    assert os.path.exists(marker)
    _run(spark, polls, sink, ckpt)  # restart on the same checkpoint
    _same(read_sink(spark, sink), first_success_per_key(decode_posts(stored_log(spark, SF001))))


def test_a_new_checkpoint_continues_an_old_table(spark, scratch):
    """The table was filled by the other writer; later records repeat stored keys and bring new ones."""
    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")
    log = stored_log(spark, SF001)
    write_log(log.where("offset < 25"), src, mode="append")
    drain(run_exactly_once(read_log_stream(spark, "table", path=src), sink, scratch("ckpt")))
    first = read_sink(spark, sink).count()
    again = log.where("offset < 25").withColumn("offset", F.col("offset") + 10_000)  # every stored key comes again
    write_log(log.where("offset >= 25").unionAll(again), src, mode="append")
    starts = resume_point(spark, sink)

    def resume():
        ks = keyed_state_session(spark, 2)
        stream = read_log_stream(ks, "table", path=src, start_offsets=starts)
        drain(run_exactly_once_keyed(stream, sink, ckpt, resume=True, buckets=16))

    resume()
    got = read_sink(spark, sink)
    _same(got, first_success_per_key(decode_posts(read_log(spark, src))))
    assert got.where("batch_id = 0").count() == first and got.agg(F.max("batch_id")).first()[0] >= 1
    resume()  # nothing new: nothing is added
    assert read_sink(spark, sink).count() == got.count()


def test_only_rows_of_repeated_keys_are_sorted():
    import pandas as pd

    from ledgerline.streaming.keyed import _firsts

    pdf = pd.DataFrame({"key": ["c", "b", "a", "b", "b"], "partition": [0, 1, 0, 0, 0], "offset": [5, 0, 1, 9, 3], "topic": "t"})
    assert _firsts(pdf.drop_duplicates("key")).index.tolist() == [0, 1, 2]
    assert _firsts(pdf).index.tolist() == [0, 2, 4]
    assert _firsts(pdf[pdf["key"] == "b"]).index.tolist() == [4]
