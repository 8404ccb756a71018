"""Order within a log partition: dense positions at scale, in-order processing, decoupling, merging.

The one expensive primitive here is :func:`dense_positions` (``row_number`` within a group). A plain
``Window.partitionBy(group).orderBy(...)`` sends a whole group to one task; a log partition can hold a
third of all rows, and a global rank (no group) puts *everything* in one task. Instead the rows are
range-partitioned on ``group + order`` (a hot group spans many tasks), sorted inside each task, and
tagged with their task id and local index. A tiny table of per-(task, group) counts gives each task's
starting position by a prefix sum; one bounded broadcast join adds it back.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_table
from .joins import join_bounded

_SP, _LI, _N, _FIRST, _BEFORE = "_ll_sp", "_ll_li", "_ll_n", "_ll_first", "_ll_before"


@dataclass
class Positioned:
    """Rows with their 0-based position in the group, plus the (small) table of group sizes."""

    rows: DataFrame
    group_sizes: DataFrame


def dense_positions(
    df: DataFrame,
    group_cols: list[str],
    order_cols: list[str],
    out_col: str = "position",
    num_partitions: int | None = None,
) -> Positioned:
    """0-based ``row_number() - 1`` over ``partition by group_cols order by order_cols``, skew-safe.

    ``order_cols`` must make the order unique inside a group (add a tie-break otherwise). The ranged
    rows are checkpointed to the shared checkpoint folder: range bounds are sampled, so the counting
    pass and the final pass must see the very same partitioning; the checkpoint also cuts lineage.
    Every column of ``df`` is checkpointed (nothing prunes through it): project before calling.
    """
    keys = [*group_cols, *order_cols]
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    ranged = (
        ranged.sortWithinPartitions(*keys)
        .withColumn(_SP, F.spark_partition_id())
        # documented layout of the id: task id in the upper 31 bits, row index in the task below
        .withColumn(_LI, F.monotonically_increasing_id() - F.shiftleft(F.col(_SP).cast("long"), 33))
        .checkpoint()
    )
    counts = ranged.groupBy(_SP, *group_cols).agg(F.count(F.lit(1)).alias(_N), F.min(_LI).alias(_FIRST))
    before = Window.partitionBy(*group_cols).orderBy(_SP).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(_BEFORE, F.coalesce(F.sum(_N).over(before), F.lit(0)).cast("long")).checkpoint()
    # per-(task, group) rows: at most tasks + groups - 1, since each task holds a contiguous key range
    n_counts = counts.count()
    tagged = _join_null_safe(ranged, counts, group_cols, n_counts)
    rows = tagged.withColumn(out_col, F.col(_BEFORE) + F.col(_LI) - F.col(_FIRST)).drop(_SP, _LI, _BEFORE, _FIRST)
    sizes = counts.groupBy(*group_cols).agg(F.sum(_N).cast("long").alias("group_size"))
    return Positioned(rows=rows, group_sizes=sizes)


def _join_null_safe(ranged: DataFrame, counts: DataFrame, group_cols: list[str], n_counts: int) -> DataFrame:
    small = counts.select(
        F.col(_SP).alias("_r" + _SP), *[F.col(c).alias("_r_" + c) for c in group_cols], _BEFORE, _FIRST
    )
    cond = F.col(_SP) == F.col("_r" + _SP)
    for c in group_cols:
        cond = cond & F.col(c).eqNullSafe(F.col("_r_" + c))
    joined = join_bounded(ranged, small, cond, rows=n_counts)
    return joined.drop("_r" + _SP, *["_r_" + c for c in group_cols])


@dataclass
class Ranges:
    """Ranges of rows in key order with fixed bounds, so that several passes see the same ones."""

    keys: list[str]
    group_cols: list[str]
    bounds: list  # the least key of each range, in order
    counts: DataFrame  # (range, group..., rows), small
    schema: T.StructType

    def number(self) -> Column:
        """The range of a row: a binary search over the bounds."""
        if len(self.bounds) < 2:
            return F.lit(0)
        # a null key field sorts first, as it does in the ranges
        bound = F.array(*[F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(b, self.schema)]) for b in self.bounds[1:]])
        key = F.struct(*[F.col(k).cast(f.dataType).alias(f.name) for k, f in zip(self.keys, self.schema)])
        steps = [1 << k for k in reversed(range(len(self.bounds).bit_length()))]

        def narrow(at: Column, step: Column) -> Column:
            return F.when(F.coalesce(F.get(bound, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at)

        return F.aggregate(F.array(*[F.lit(k) for k in steps]), F.lit(0), narrow)

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` sent to the ranges, a task each, in key order; ``_ll_sp`` is the range, ``_ll_li`` the place in it."""
        placed = df.withColumn(_SP, self.number()).repartitionById(max(1, len(self.bounds)), _SP).sortWithinPartitions(*self.keys)
        return placed.withColumn(_LI, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))


def fix_ranges(df: DataFrame, group_cols: list[str], order_cols: list[str], num_partitions: int | None = None) -> Ranges:
    """Bounds and counts of ``num_partitions`` ranges (default: the session's shuffle partitions), from the key columns
    alone. At most a row per range and group is written, and a key per range comes to the driver."""
    keys = [*group_cols, *order_cols]
    spark = df.sparkSession
    narrow = df.select(*keys).repartitionByRange(num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    heads = narrow.groupBy(F.spark_partition_id().alias("_ll_task"), *group_cols).agg(F.count(F.lit(1)).alias(_N), F.min(F.struct(*keys)).alias("_ll_head"))
    heads = scratch_table(heads, "ranges")  # the ranges are sampled: they are taken once
    found = heads.groupBy("_ll_task").agg(F.min("_ll_head").alias("head")).orderBy("_ll_task").collect()
    numbers = spark.createDataFrame([(r["_ll_task"], k) for k, r in enumerate(found)], f"_ll_task int, {_SP} int")
    counts = heads.join(F.broadcast(numbers), "_ll_task").select(_SP, *group_cols, _N)
    return Ranges(keys, group_cols, [tuple(r["head"]) for r in found], counts, T.StructType([df.schema[k] for k in keys]))


def ranged_positions(df: DataFrame, group_cols: list[str], order_cols: list[str], out_col: str = "position", num_partitions: int | None = None) -> Positioned:
    """:func:`dense_positions` for wide rows: only the key columns are read twice, and nothing but counts is stored.

    Ranges get fixed bounds from the keys; rows go to their range once, and a row's position is its place in the
    range plus what the counts say of earlier ranges (less the range's earlier groups). The order must be unique
    inside a group for the positions to be the same in every run. ``df`` is read by each action on the result.
    """
    ranges = fix_ranges(df, group_cols, order_cols, num_partitions)
    before = Window.partitionBy(*group_cols).orderBy(_SP).rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum(_N).over(before), F.lit(0))
    if group_cols:
        inside = Window.partitionBy(_SP).orderBy(*group_cols).rowsBetween(Window.unboundedPreceding, -1)
        shift = shift - F.coalesce(F.sum(_N).over(inside), F.lit(0))
    counts = scratch_table(ranges.counts.select(_SP, *group_cols, _N, shift.cast("long").alias(_BEFORE), F.lit(0).cast("long").alias(_FIRST)), "range-counts")
    tagged = _join_null_safe(ranges.place(df), counts, group_cols, counts.count())
    rows = tagged.withColumn(out_col, F.col(_BEFORE) + F.col(_LI)).drop(_SP, _LI, _BEFORE, _FIRST)
    return Positioned(rows=rows, group_sizes=counts.groupBy(*group_cols).agg(F.sum(_N).cast("long").alias("group_size")))


class OrderedFold:
    """A sequential function over the rows of a log partition, in parts: what a run of rows does to the state is a
    *summary*, and summaries of neighbouring runs combine. ``start``, states and summaries are JSON values."""

    start: object = None
    schema: str = ""

    def summary(self, rows):
        """What a run of rows (a pandas frame of one partition, in offset order) does to the state."""
        raise NotImplementedError

    def combine(self, left, right):
        """The summary of two runs, one after the other."""
        raise NotImplementedError

    def enter(self, state, summary):
        """The state after a run with that summary."""
        raise NotImplementedError

    def run(self, state, rows):
        """(the output frame of ``schema``, the state after the rows)."""
        raise NotImplementedError


def _runs(frames: Iterator) -> Iterator[tuple]:
    """((range, topic, partition), rows) of each frame's stretches of one partition."""
    for pdf in frames:
        if len(pdf):
            for key, rows in pdf.groupby([_SP, "topic", "partition"], sort=False, dropna=False):
                yield tuple(None if v != v else v for v in key), rows.drop(columns=[_SP])


def fold_in_order(log: DataFrame, fold: OrderedFold, num_partitions: int | None = None) -> DataFrame:
    """O1 with state: ``fold`` over each partition's records in offset order, as one task per partition would run it, in
    as many tasks as there are ranges. Pass one takes a summary of every range and partition; the summaries (a
    row per range and partition) are combined in order, which gives every range the state it begins with;
    pass two runs the ranges again. ``log`` should have the columns that ``fold`` reads, and no others."""
    from ..session import ship_package

    spark = log.sparkSession
    ship_package(spark)
    ranges = fix_ranges(log, ["topic", "partition"], ["offset"], num_partitions)
    placed = ranges.place(log).drop(_LI)

    def summarise(frames):
        import pandas as pd

        key, found = None, None
        for k, rows in _runs(frames):
            mine = fold.summary(rows)
            if key is not None and k != key:
                yield pd.DataFrame({"range": [key[0]], "topic": [key[1]], "partition": [key[2]], "summary": [json.dumps(found)]})
                found = None
            key, found = k, mine if found is None else fold.combine(found, mine)
        if key is not None:
            yield pd.DataFrame({"range": [key[0]], "topic": [key[1]], "partition": [key[2]], "summary": [json.dumps(found)]})

    summaries = placed.mapInPandas(summarise, "range int, topic string, partition int, summary string").collect()
    states, entry = {}, {}
    for r in sorted(summaries, key=lambda r: r["range"]):
        part = (r["topic"], r["partition"])
        entry[(r["range"], *part)] = states.get(part, fold.start)
        states[part] = fold.enter(entry[(r["range"], *part)], json.loads(r["summary"]))
    shared = spark.sparkContext.broadcast(entry)

    def run(frames):
        key, state = None, None
        for k, rows in _runs(frames):
            state = state if k == key else shared.value[k]
            key = k
            out, state = fold.run(state, rows)
            yield out

    return placed.mapInPandas(run, fold.schema)


def ordered_positions(log: DataFrame, out_col: str = "position") -> DataFrame:
    """O1 as a column: each record's 0-based position in its partition, in offset order."""
    return dense_positions(log, ["topic", "partition"], ["offset"], out_col).rows


def in_partition_order(
    log: DataFrame,
    fn: Callable,
    schema: T.StructType | str,
    num_partitions: int | None = None,
    lanes: str = "range",
) -> DataFrame:
    """O1: run ``fn`` (iterator of pandas frames -> iterator of pandas frames) over each partition in offset order.

    ``lanes="range"`` (default): rows are range-partitioned on (topic, partition, offset) and sorted in
    each task, so every task sees contiguous ascending offset ranges and a hot log partition is spread
    over several tasks; ``fn`` must not carry state from one range to the next (combine ranges with a
    prefix step, as :func:`dense_positions` does).

    ``lanes="partition"``: one task sees *all* of a log partition, strictly in offset order (one
    sequential lane per partition, as a consumer per partition has). The price is that a hot partition
    is one task; use it only when ``fn`` really needs the whole partition in sequence.
    """
    keys = ["topic", "partition", "offset"]
    if lanes == "range":
        placed = log.repartitionByRange(num_partitions, *keys) if num_partitions else log.repartitionByRange(*keys)
    elif lanes == "partition":
        placed = log.repartition(num_partitions, "topic", "partition") if num_partitions else log.repartition("topic", "partition")
    else:
        raise ValueError(f"lanes must be 'range' or 'partition', not {lanes!r}")
    from ..session import ship_package

    ship_package(log.sparkSession)
    return placed.sortWithinPartitions(*keys).mapInPandas(fn, schema)


def decouple(log: DataFrame, n: int | None = None) -> DataFrame:
    """O2: processing parallelism independent of the log's partitions (order not kept): partitions of a size
    that the session's settings advise, or ``n`` of them."""
    return log.hint("rebalance") if n is None else log.repartition(n)


def per_partition(log: DataFrame, fn: Callable, schema: T.StructType | str) -> DataFrame:
    """O3: each log partition as its own sub-stream, unordered across partitions.

    ``fn`` gets an iterator of pandas frames of one task's rows; the rows of a partition may come in
    several tasks (a hot partition is split), so ``fn`` should emit partial results that the caller
    combines with a ``groupBy`` (partial + final aggregation).
    """
    from ..session import ship_package

    ship_package(log.sparkSession)
    keys = ["topic", "partition", "offset"]
    return log.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInPandas(fn, schema)
