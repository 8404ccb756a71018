"""Delivery audits (T9): records delivered more than once, records never stored, offsets never completed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .joins import fits_broadcast, join_bounded
from .ordering import fix_ranges


def audit_duplicates(delivered: DataFrame, keys: list[str], offset_col: str = "offset") -> DataFrame:
    """Groups of ``keys`` that appear more than once, with their copy count and offset range."""
    return (
        delivered.groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(offset_col).alias("first_offset"),
            F.max(offset_col).alias("last_offset"),
        )
        .where(F.col("copies") > 1)
    )


#: Offsets of a block.
BLOCK = 1_024


def block_sums(positions: DataFrame, block: int = BLOCK) -> DataFrame:
    """(topic, partition, block, n, x, s): count and two sums of position hashes per block of offsets; partial
    aggregates, so a row per block and task is all that is shuffled."""
    h = F.xxhash64("topic", "partition", "offset")
    rows = positions.select("topic", "partition", F.floor(F.col("offset") / block).cast("long").alias("block"), h.alias("h"))
    return rows.groupBy("topic", "partition", "block").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF))).alias("s"))


def _differing(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    l, r = left.alias("l"), right.alias("r")
    met = l.join(r, keys, "full")
    same = F.col("l.n").eqNullSafe(F.col("r.n")) & F.col("l.x").eqNullSafe(F.col("r.x")) & F.col("l.s").eqNullSafe(F.col("r.s"))
    return met.where(~same).select(*keys)


def differing_blocks(log: DataFrame, stored: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks (topic, partition, block) of offsets whose positions are not the same in both, found level by level:
    sums of whole partitions first, then the blocks of partitions that differ. Block sums are computed once."""
    left, right = (scratch_table(block_sums(df, block), "block-sums") for df in (log, stored))
    keys = ["topic", "partition"]
    whole = [df.groupBy(*keys).agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s")) for df in (left, right)]
    partitions = _differing(*whole, keys).collect()  # a row per partition of the log at most
    found = left.sparkSession.createDataFrame([tuple(r) for r in partitions], "topic string, partition int")
    if not partitions:
        return left.select(*keys, "block").limit(0)
    near = [join_bounded(df, found, keys, "left_semi", rows=len(partitions)) for df in (left, right)]
    return scratch_table(_differing(*near, [*keys, "block"]), "differing-blocks")


def audit_missing(log: DataFrame, sink: DataFrame, block: int = BLOCK) -> DataFrame:
    """Log records whose position is not in the sink, with the key and whether that key is stored.

    Log and sink are compared by hash sums of their positions per block of offsets, level by level; where
    they agree, the sums are all that was read and shuffled. Records of blocks that differ meet the sink's positions in
    a join on (topic, partition, offset), which is unique and so balanced. The key flag is computed on distinct keys (a
    key with many missing copies collapses map-side) semi-joined with the stored ids, and brought back by a
    broadcast after a size check, so the missing records are never shuffled by key. A record without a
    topic, partition or offset is in no sink. What lies between is in scratch tables; nothing is cached.
    """
    stored = sink.select(
        "topic", F.col("topic_partition").cast("int").alias("partition"), F.col("partition_offset").alias("offset")
    ).where("topic is not null and partition is not null and offset is not null")
    log = log.select("key", "topic", "partition", "offset")
    placed = log.where("topic is not null and partition is not null and offset is not null")
    blocks = differing_blocks(placed, stored, block)
    unplaced = log.where("topic is null or partition is null or offset is null")
    n_blocks = blocks.count()
    if n_blocks:
        inside = F.floor(F.col("offset") / block).cast("long")
        at = ["topic", "partition", "block"]
        here = join_bounded(placed.withColumn("block", inside), blocks, at, "left_semi", rows=n_blocks)
        there = join_bounded(stored.withColumn("block", inside), blocks, at, "left_semi", rows=n_blocks)
        missing = here.join(there, [*at, "offset"], "left_anti").select(*log.columns).unionAll(unplaced)
    else:
        missing = unplaced
    missing = scratch_table(missing, "missing")
    keys = missing.select("key").where("key is not null").distinct()
    n_keys = keys.count()
    if not n_keys:
        return missing.withColumn("key_stored", F.lit(False))
    side = F.broadcast(keys) if fits_broadcast(keys, n_keys) else keys
    ids = sink.select(F.col("id").alias("key")).join(side, "key", "left_semi").distinct()
    flags = scratch_table(ids.withColumn("_stored", F.lit(True)), "stored-keys")
    flagged = join_bounded(missing, flags, ["key"], "left")
    return flagged.select(
        "key", "topic", "partition", "offset", F.coalesce(F.col("_stored"), F.lit(False)).alias("key_stored")
    )


def completion_gaps(done: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Per completed interval of offsets (topic, partition, lo, hi; ``hi`` exclusive) the completed end before it:
    (topic, partition, lo, hi, reached), ``reached`` null for a partition's first.

    Intervals may overlap, repeat (retries) and come in any order and from any number of tasks. They are cut into ranges of
    (topic, partition, lo); a running maximum inside each range and one over the ranges' maxima give the
    end reached, so a partition with most intervals is many groups and no window spans it. Null or empty intervals
    are dropped.
    """
    done = done.select("topic", "partition", "lo", "hi").where("topic is not null and partition is not null and lo < hi").distinct()
    done = scratch_table(done, "intervals")
    ranges = fix_ranges(done, ["topic", "partition"], ["lo", "hi"], num_partitions)
    numbered = done.withColumn("_r", ranges.number())
    ends = numbered.groupBy("topic", "partition", "_r").agg(F.max("hi").alias("_end"))  # a row per range and partition
    earlier = Window.partitionBy("topic", "partition").orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    ends = scratch_table(ends.select("topic", "partition", "_r", F.max("_end").over(earlier).alias("_before")), "range-ends")
    inside = Window.partitionBy("topic", "partition", "_r").orderBy("lo", "hi").rowsBetween(Window.unboundedPreceding, -1)
    met = join_bounded(numbered.withColumn("_inside", F.max("hi").over(inside)), ends, ["topic", "partition", "_r"])
    return met.select("topic", "partition", "lo", "hi", F.greatest("_inside", "_before").alias("reached"))


def missing_ranges(done: DataFrame, start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """(topic, partition, lo, hi): offsets from ``start`` on that no interval of ``done`` covers, though a later one does."""
    gaps = completion_gaps(done, num_partitions).withColumn("reached", F.greatest(F.coalesce("reached", F.lit(start)), F.lit(start)))
    return gaps.where("lo > reached").select("topic", "partition", F.col("reached").cast("long").alias("lo"), F.col("lo").alias("hi"))


def completion_frontier(done: DataFrame, start: int = 0, num_partitions: int | None = None) -> DataFrame:
    """(topic, partition, frontier, highest, n_gaps, n_missing): every offset from ``start`` to below ``frontier`` is
    complete, so that is what may be committed; ``highest`` is one past the last completed offset."""
    gaps = completion_gaps(done, num_partitions).withColumn("reached", F.greatest(F.coalesce("reached", F.lit(start)), F.lit(start)))
    gap = F.col("lo") > F.col("reached")
    found = gaps.groupBy("topic", "partition").agg(
        F.min(F.when(gap, F.col("reached"))).alias("_first"), F.greatest(F.max("hi"), F.lit(start)).cast("long").alias("highest"),
        F.count_if(gap).alias("n_gaps"), F.coalesce(F.sum(F.when(gap, F.col("lo") - F.col("reached"))), F.lit(0)).cast("long").alias("n_missing"))
    return found.select("topic", "partition", F.coalesce("_first", "highest").cast("long").alias("frontier"), "highest", "n_gaps", "n_missing")
