"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is forced with the ``noop`` sink (full evaluation, nothing collected to the driver). The
stored log (derive offsets from `events`, write partitioned parquet) is timed on its own as
``log_build``; queries then read it.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.session import build_session  # noqa: E402
from ledgerline.sources.log import stored_log  # noqa: E402
from ledgerline.plans.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "decode_posts",
    "first_success_per_key",
    "commit_ledger",
    "quarantine",
    "ordered_position",
    "even_split_equal",
    "resume_from_sink",
    "new_ids_only",
    "audit_missing",
    "audit_duplicates",
    "publish_encode",
    "exactly_once_sink",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if a in QUERIES]
    names = only or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2), app="ledgerline-bench")
    timings: dict[str, float] = {}
    rows: dict[str, int] = {}

    t0 = time.time()
    log = stored_log(spark, sf_dir)
    timings["log_build"] = round(time.time() - t0, 3)
    n_log = log.count()
    for name in names:
        t0 = time.time()
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - t0, 3)
    for name in ("decode_posts", "first_success_per_key", "exactly_once_sink", "commit_ledger"):
        if name in timings and timings[name] > 0:
            rows[name] = int(n_log / timings[name])
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {
        "metric": "total_query_time",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "log_records": n_log,
        "log_records_per_sec": rows,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
