"""Split ordered rows into k balanced chunks (O5) and assign chunks to readers.

Rule, with n rows, q = n div k, r = n mod k and 0-based position i: rows i < q*k go to chunk i div q;
the r tail rows go to chunk i - q*k when ``equal`` (one extra each for the first chunks), else all to
chunk k-1. Sizes equal those of ``ntile(k)`` but membership differs: the extras come from the tail.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordering import dense_positions


def check_split(n: int, k: int, strict: bool = True) -> tuple[int, int]:
    """(q, r) for n rows into k chunks; raise for the shapes the sequential splitter cannot produce."""
    if k <= 0:
        raise ValueError("k must be positive")
    q, r = divmod(n, k)
    if strict and n > 0:
        if q == 0:
            raise ValueError(f"cannot split {n} rows into {k} chunks: fewer rows than chunks")
        if r > 0 and r >= q:
            raise ValueError(f"cannot split {n} rows into {k} chunks: remainder {r} >= chunk size {q}")
    return q, r


def split_id(position, q: int, r: int, k: int, equal: bool):
    """The chunk of a 0-based position (a column expression)."""
    head = q * k
    tail = (position - F.lit(head)) if equal else F.lit(k - 1)
    if q == 0:
        return tail.cast("int")
    return F.when(position < head, F.floor(position / F.lit(q))).otherwise(tail).cast("int")


def even_split(
    df: DataFrame,
    k: int,
    order_by: list[str],
    equal: bool = True,
    strict: bool = True,
    out_col: str = "split_id",
) -> DataFrame:
    """O5 over a DataFrame: add ``out_col`` in [0, k). ``order_by`` must be unique.

    Positions come from :func:`dense_positions` (range partitions + prefix sums), never a single-task
    window; only n (one number) reaches the driver.
    """
    placed = dense_positions(df, [], order_by, "_ll_pos")
    n = placed.group_sizes.agg(F.sum("group_size")).first()[0] or 0
    q, r = check_split(int(n), k, strict)
    return placed.rows.withColumn(out_col, split_id(F.col("_ll_pos"), q, r, k, equal)).drop("_ll_pos")


def split_list(items: list, k: int, equal: bool = True, strict: bool = True) -> list[list]:
    """O5 for a small driver-side list (e.g. a handful of partition numbers)."""
    q, r = check_split(len(items), k, strict)
    if not items:
        return []
    groups: list[list] = [[] for _ in range(k)]
    head = q * k
    for i, item in enumerate(items):
        if i < head:
            g = i // q
        else:
            g = (i - head) if equal else k - 1
        groups[g].append(item)
    return [g for g in groups if g] if q == 0 else groups


def assign_splits(partitions: DataFrame, k: int, equal: bool = True, strict: bool = True) -> DataFrame:
    """The partition list split into k chunks, one sorted list of (topic, partition) per reader.

    Each list is bounded by the topic's partition count, so collecting it per chunk is safe.
    """
    split = even_split(partitions.select("topic", "partition"), k, ["topic", "partition"], equal, strict)
    return split.groupBy("split_id").agg(F.sort_array(F.collect_list(F.struct("topic", "partition"))).alias("partitions"))
