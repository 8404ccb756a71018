"""Stage and task times from Spark's event log (no UI): run named queries with the event log written to
a fresh scratch folder, then report per stage the task count and the max / median task time.

Usage: python tools/stages.py [sf_dir] name [name ...]
A stage whose max task time is far above its median has a hot task (skew).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    log_dir = tempfile.mkdtemp(prefix="ledgerline-events-")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", log_dir)
        .config("spark.eventLog.compress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerline.plans.catalog import QUERIES

    from ledgerline.sources.log import stored_log

    spark.sparkContext.setJobGroup("log_build", "log_build")
    stored_log(spark, sf_dir)
    for name in names:
        spark.sparkContext.setJobGroup(name, name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    tasks: dict[int, list[float]] = {}
    stage_names: dict[int, str] = {}
    query: dict[int, str] = {}
    # Spark 4 writes a folder of rolling event files per application
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerTaskEnd":
                    info = ev["Task Info"]
                    tasks.setdefault(ev["Stage ID"], []).append((info["Finish Time"] - info["Launch Time"]) / 1000.0)
                elif kind == "SparkListenerJobStart":
                    group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "?")
                    for sid in ev.get("Stage IDs", []):
                        query.setdefault(sid, group)
                elif kind == "SparkListenerStageCompleted":
                    stage = ev["Stage Info"]
                    stage_names[stage["Stage ID"]] = stage["Stage Name"].split(" at ")[0]
    rows = []
    for sid, times in tasks.items():
        med = statistics.median(times)
        rows.append((max(times), sid, len(times), med, query.get(sid, "?"), stage_names.get(sid, "?")))
    print(f"{'stage':>5} {'tasks':>5} {'max_s':>7} {'median_s':>8} {'max/med':>7}  query / stage")
    for mx, sid, n, med, q, nm in sorted(rows, reverse=True)[:25]:
        ratio = mx / med if med > 0 else float("inf")
        print(f"{sid:>5} {n:>5} {mx:>7.3f} {med:>8.3f} {ratio:>7.1f}  {q} / {nm}")


if __name__ == "__main__":
    main()
