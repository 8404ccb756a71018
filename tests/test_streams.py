"""Failure injection and restart for the stream runs."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.audit import audit_duplicates, audit_missing
from ledgerline.operators.sink import first_success_per_key, init_sink, read_sink
from ledgerline.functions.codec import decode_posts
from ledgerline.sources.log import read_log_stream, stored_log
from ledgerline.streaming.runs import (
    at_least_once_writer,
    drain,
    exactly_once_writer,
    read_ledger,
    run_exactly_once,
    start_batches,
)
from conftest import SF001, write_poll_files


class Boom(RuntimeError):
    pass


def failing_once(process, fail_batch, state):
    """Run ``process``, then raise once right after batch ``fail_batch`` was written."""

    def wrapped(df, batch_id):
        process(df, batch_id)
        if batch_id == fail_batch and not state.get("failed"):
            state["failed"] = True
            raise Boom(f"injected after batch {batch_id}")

    return wrapped


@pytest.fixture(scope="module")
def polls(spark):
    from ledgerline.session import scratch_path

    path = scratch_path(spark, "tests", "polls")
    # 20 records per file: the sf0.001 log (~1,000 records, ~55 per partition) gives several batches
    write_poll_files(stored_log(spark, SF001), path, records_per_file=20)
    return path


def _run_with_failure(spark, process, polls, ckpt, fail_batch=1):
    state = {}
    q = start_batches(read_log_stream(spark, "files", path=polls), failing_once(process, fail_batch, state), ckpt)
    with pytest.raises(Exception):
        drain(q)
    assert state.get("failed")
    # restart on the same checkpoint: the failed batch runs again with the same id and data
    drain(start_batches(read_log_stream(spark, "files", path=polls), process, ckpt))


def test_exactly_once_survives_replay(spark, scratch, polls):
    sink, ledger, ckpt = scratch("sink"), scratch("ledger"), scratch("ckpt")
    init_sink(spark, sink)
    _run_with_failure(spark, exactly_once_writer(sink, ledger), polls, ckpt)
    log = stored_log(spark, SF001)
    got = read_sink(spark, sink).drop("batch_id")
    want = first_success_per_key(decode_posts(log))
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0
    assert audit_duplicates(got, ["id"], "partition_offset").count() == 0
    # the ledger equals the batch ledger of the whole log
    ledger_rows = {(r["partition"], r["next_offset"]) for r in read_ledger(spark, ledger).collect()}
    want_ledger = {(r[0], r[1]) for r in log.groupBy("partition").agg(F.max("offset") + 1).collect()}
    assert ledger_rows == want_ledger


def test_at_least_once_repeats_the_failed_batch(spark, scratch, polls):
    out, ckpt = scratch("alo"), scratch("ckpt")
    _run_with_failure(spark, at_least_once_writer(out), polls, ckpt)
    delivered = spark.read.schema("post_id string, partition int, offset long").parquet(out)
    repeats = audit_duplicates(delivered, ["partition", "offset"]).collect()
    assert repeats, "the replayed batch must show up as repeats"
    # offsets in [20, 40) form batch 1 (one file per trigger)
    assert all(20 <= r["first_offset"] < 40 and r["copies"] == 2 for r in repeats)


def test_restart_without_new_data_adds_nothing_and_new_file_adds_its_rows(spark, scratch):
    log = stored_log(spark, SF001)
    src, sink, ckpt = scratch("src"), scratch("sink"), scratch("ckpt")
    write_poll_files(log, src, records_per_file=20, polls=range(0, 2))
    drain(run_exactly_once(read_log_stream(spark, "files", path=src), sink, ckpt))
    first = read_sink(spark, sink).count()
    drain(run_exactly_once(read_log_stream(spark, "files", path=src), sink, ckpt))
    assert read_sink(spark, sink).count() == first
    write_poll_files(log, src, records_per_file=20, polls=range(2, 3))
    drain(run_exactly_once(read_log_stream(spark, "files", path=src), sink, ckpt))
    want = first_success_per_key(decode_posts(log.where(F.col("offset") < 60))).count()
    assert read_sink(spark, sink).count() == want


def test_new_checkpoint_requires_empty_sink(spark, scratch, polls):
    sink = scratch("sink")
    drain(run_exactly_once(read_log_stream(spark, "files", path=polls), sink, scratch("ckpt")))
    with pytest.raises(ValueError):
        run_exactly_once(read_log_stream(spark, "files", path=polls), sink, scratch("ckpt"))


def test_audit_missing_lists_bad_and_duplicate_records(spark, scratch, polls):
    sink, ckpt = scratch("sink"), scratch("ckpt")
    drain(run_exactly_once(read_log_stream(spark, "files", path=polls), sink, ckpt))
    log = stored_log(spark, SF001)
    missing = audit_missing(log, read_sink(spark, sink))
    bad = decode_posts(log).where(~F.col("decode_status").isin("ok", "skip")).count()
    dup_keys = missing.where("key_stored").count()
    assert missing.count() == bad + dup_keys
    assert missing.where(~F.col("key_stored")).count() == bad


def test_fail_stop_stream_raises_on_bad_record(spark, scratch, polls):
    sink, ckpt = scratch("sink"), scratch("ckpt")
    init_sink(spark, sink)
    process = exactly_once_writer(sink, on_error="fail")
    q = start_batches(read_log_stream(spark, "files", path=polls), process, ckpt)
    with pytest.raises(Exception, match="bad record"):
        drain(q)


def test_live_stream_with_poll_interval_drains_and_stops(spark, scratch, polls):
    from ledgerline.streaming.runs import run_at_least_once

    out, ckpt = scratch("live"), scratch("ckpt")
    q = run_at_least_once(read_log_stream(spark, "files", path=polls, max_files_per_trigger=3), out, ckpt,
                          available_now=False, processing_time="1 second")
    q.processAllAvailable()
    assert q.isActive
    drain(q, timeout_s=1)  # still running after the timeout: stopped
    assert not q.isActive
    delivered = spark.read.schema("post_id string, partition int, offset long").parquet(out)
    want = decode_posts(stored_log(spark, SF001)).where("decode_status = 'ok'").count()
    assert delivered.count() == want


def test_quarantine_table_holds_bad_records_once(spark, scratch, polls):
    sink, quarantine, ckpt = scratch("sink"), scratch("quarantine"), scratch("ckpt")
    drain(run_exactly_once(read_log_stream(spark, "files", path=polls), sink, ckpt, quarantine_path=quarantine))
    got = spark.read.parquet(quarantine)
    bad = decode_posts(stored_log(spark, SF001)).where(~F.col("decode_status").isin("ok", "skip"))
    assert got.count() == bad.count() > 0
    assert got.select("partition", "offset").distinct().count() == got.count()
    assert {r[0] for r in got.select("reason").distinct().collect()} == {"malformed", "empty", "unknown_field", "nested_value"}


def test_resume_from_the_table_with_a_new_checkpoint(spark, scratch):
    """The stored-offset consumer: a second run with a new checkpoint seeks from the table itself."""
    from ledgerline.streaming.runs import resume_point

    log = stored_log(spark, SF001)
    src, sink = scratch("src"), scratch("sink")
    write_poll_files(log, src, records_per_file=20, polls=range(0, 2))
    drain(run_exactly_once(read_log_stream(spark, "files", path=src), sink, scratch("ckpt")))
    first = read_sink(spark, sink).count()
    write_poll_files(log, src, records_per_file=20, polls=range(2, 4))
    ckpt2 = scratch("ckpt")
    starts = resume_point(spark, sink)
    drain(run_exactly_once(read_log_stream(spark, "files", path=src, start_offsets=starts), sink, ckpt2, resume=True))
    got = read_sink(spark, sink)
    want = first_success_per_key(decode_posts(log.where(F.col("offset") < 80)))
    assert got.count() > first
    assert audit_duplicates(got, ["id"], "partition_offset").count() == 0
    assert got.drop("batch_id").exceptAll(want).count() == 0 and want.exceptAll(got.drop("batch_id")).count() == 0
    # the resumed run's batch ids continue after the first run's
    assert got.agg(F.min("batch_id")).first()[0] == 0
    # a restart of the resumed run with nothing new adds nothing
    n = got.count()
    drain(run_exactly_once(read_log_stream(spark, "files", path=src, start_offsets=starts), sink, ckpt2, resume=True))
    assert read_sink(spark, sink).count() == n


def test_at_least_once_ledger_equals_batch_ledger(spark, scratch, polls):
    from ledgerline.operators.ledger import commit_ledger
    from ledgerline.streaming.runs import run_at_least_once

    out, ledger, ckpt = scratch("alo"), scratch("ledger"), scratch("ckpt")
    drain(run_at_least_once(read_log_stream(spark, "files", path=polls), out, ckpt, ledger_path=ledger))
    got = {(r["partition"], r["next_offset"]) for r in read_ledger(spark, ledger).collect()}
    want = {(r["partition"], r["next_offset"]) for r in commit_ledger(stored_log(spark, SF001)).collect()}
    assert got == want
