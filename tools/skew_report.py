"""Skew report: run the hot-key-sensitive operators on a synthetic log where one key and one partition
hold 40% of 2M records (a measurement harness, not a registered query) and print, per shuffle stage,
the largest task's share of the shuffled records (from Spark's event log in a fresh scratch folder).

Usage: python tools/skew_report.py
"""

import glob
import json
import os
import statistics  # noqa: F401
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import SparkSession, Window, functions as F
log_dir = tempfile.mkdtemp(prefix="ledgerline-skew-events-")
spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", "16").config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
         .config("spark.eventLog.compress", "false").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from ledgerline.functions.codec import decode_posts
from ledgerline.operators.sink import first_success_per_key
from ledgerline.operators.ordering import dense_positions
from ledgerline.operators.audit import audit_duplicates
n = 2_000_000
ids = spark.range(n)
hot = F.col("id") % 5 < 2
key = F.when(hot, F.lit("hot")).otherwise(F.col("id").cast("string"))
part = F.when(hot, F.lit(0)).otherwise((F.col("id") % 19 + 1).cast("int"))
value = F.to_json(F.struct(key.alias("id"), F.col("id").cast("string").alias("text")))
log = ids.select(key.alias("key"), value.alias("value"), F.lit("t").alias("topic"), part.alias("partition"), F.col("id").alias("offset")).repartition(16).persist()
log.count()
builders = [
    ("first_success", lambda: first_success_per_key(decode_posts(log))),
    ("dense_positions", lambda: dense_positions(log.select("topic", "partition", "offset"), ["topic", "partition"], ["offset"], "pos").rows),
    ("audit_duplicates", lambda: audit_duplicates(log, ["key"])),
    ("plain_window_row_number", lambda: log.select("partition", "offset").withColumn("rn", F.row_number().over(Window.partitionBy("partition").orderBy("offset")))),
]
for name, build in builders:
    spark.sparkContext.setJobGroup(name, name)
    build().write.format("noop").mode("overwrite").save()
spark.stop()
tasks, query = {}, {}
for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
    if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"): continue
    for line in open(path):
        ev = json.loads(line)
        if ev.get("Event") == "SparkListenerTaskEnd":
            m = ev.get("Task Metrics") or {}
            recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            tasks.setdefault(ev["Stage ID"], []).append(recs)
        elif ev.get("Event") == "SparkListenerJobStart":
            g = (ev.get("Properties") or {}).get("spark.jobGroup.id", "setup")
            for s in ev.get("Stage IDs", []): query.setdefault(s, g)
worst = {}
for sid, recs in tasks.items():
    q = query.get(sid, "?")
    total = sum(recs)
    if total == 0: continue
    share = max(recs) / total
    if share > worst.get(q, (0,))[0]: worst[q] = (round(share, 3), len(recs), max(recs), total)
for sid, recs in sorted(tasks.items()):
    if sum(recs) > 1000:
        print("stage", sid, query.get(sid, "?"), "tasks", len(recs), "largest share %.3f" % (max(recs) / sum(recs)), "records", sum(recs))
