"""The derived log L1: the `events` table published as a partitioned, offset-addressed topic.

Every record of `events` becomes a post (key = event id) in partition ``user_id mod 20``; producer
retries, tombstones and malformed values are mixed in, so that decode, dedupe and audit paths all see
real cases. Offsets are dense per partition, in (attempt, event id) order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import encode_post, iso_text
from ..operators.ordering import ranged_positions
from ..schema import DEFAULT_PARTITIONS, LOG_COLUMNS, TOPIC

# Fixed values of the fixture: every 50th event is sent again (a producer retry, later offset),
# every 97th event is a tombstone (NULL value), every 89th a bad value: malformed, empty, with a field that is not
# known, with an object for a text, by turns.
RETRY_EVERY = 50
TOMBSTONE_EVERY = 97
MALFORMED_EVERY = 89
BAD_VALUES = ("{bad", "   ", '{"id":"x","extra":1}', '{"id":{"of":"x"}}')


def post_fields(events: DataFrame) -> dict:
    """The post published for an event (what the producer sends)."""
    created = iso_text(F.col("ts"))
    return {
        "id": F.col("event_id").cast("string"),
        "author": F.concat(F.lit("author"), F.col("user_id").cast("string")),
        "description": F.concat(F.lit("description"), F.col("event_type")),
        "text": F.col("props"),
        "createdAt": created,
        "updatedAt": created,
    }


def derived_log(events: DataFrame, n_partitions: int = DEFAULT_PARTITIONS) -> DataFrame:
    """L1 from `events`: columns key, value, topic, partition, offset, timestamp."""
    first = events.withColumn("attempt", F.lit(0))
    retries = events.where(F.col("event_id") % RETRY_EVERY == 0).withColumn("attempt", F.lit(1))
    sent = first.unionByName(retries)
    value = (
        F.when(F.col("event_id") % TOMBSTONE_EVERY == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % MALFORMED_EVERY == 0, F.element_at(F.array(*[F.lit(v) for v in BAD_VALUES]), (F.floor(F.col("event_id") / MALFORMED_EVERY) % len(BAD_VALUES) + 1).cast("int")))
        .otherwise(encode_post(post_fields(events)))
    )
    # rows go to their ranges as events, much smaller than posts, and are encoded there by as many tasks as there are ranges
    records = sent.withColumn("_ll_partition", (F.col("user_id") % n_partitions).cast("int"))
    placed = ranged_positions(records, ["_ll_partition"], ["attempt", "event_id"], "_ll_offset").rows
    return placed.select(
        F.col("event_id").cast("string").alias("key"),
        value.alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.col("_ll_partition").alias("partition"),
        F.col("_ll_offset").alias("offset"),
        F.col("ts").alias("timestamp"),
    ).select(*LOG_COLUMNS)
