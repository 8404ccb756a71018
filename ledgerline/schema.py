"""Schemas of the data model: the post payload, the log record, the sink table and the ledger."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's: the topic name, the payload fields in declaration order,
# the records-per-poll limit and the partition count of the documented run.
TOPIC = "posts"
POST_FIELDS = ["id", "author", "description", "text", "createdAt", "updatedAt"]
MAX_RECORDS_PER_POLL = 100
DEFAULT_PARTITIONS = 20

POST_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in POST_FIELDS])

# Same column names as Spark's Kafka source after CAST(key/value AS STRING).
LOG_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType(), True),
        T.StructField("value", T.StringType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("offset", T.LongType(), True),
        T.StructField("timestamp", T.TimestampNTZType(), True),
    ]
)
LOG_COLUMNS = [f.name for f in LOG_SCHEMA.fields]

# Result table of the effectively-once sink; ``batch_id`` is the micro-batch that stored the row.
SINK_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("post_json", T.StringType(), True),
        T.StructField("topic", T.StringType(), True),
        T.StructField("topic_partition", T.LongType(), True),
        T.StructField("partition_offset", T.LongType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)
SINK_COLUMNS = [f.name for f in SINK_SCHEMA.fields]

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType(), True),
        T.StructField("partition", T.IntegerType(), True),
        T.StructField("next_offset", T.LongType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)
