"""Exact top-k search by inner product: a ball tree per shard, branch and bound with a shared k-th score.

Vectors are dealt to shards of about ``SHARD`` rows, near ones together (nearest of a few pivots, split by hash
where a cell is too large). One task per shard builds its ball tree as flat arrays. A query's inner product
with anything in a ball is at most ``q . centre + |q| * radius``; nodes are visited in the order of this bound
and the search of a shard stops when the next bound is below the k-th best score so far. That score is shared:
a query first searches the shard with the highest bound, then takes its k-th score along to the other shards,
and skips those whose root bound is below it. Scores are integers and exact; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ready, stored

SHARD = 4_096
PIVOTS = 64
LEAF = 64
#: Double precision holds all integers up to here, so an inner product whose parts cannot sum to more is exact.
EXACT = float(1 << 53)


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, dim, x): floor(scale * component) in double precision; vectors without null or non-finite components."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    rows = rows.where(~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c * scale) == float("inf"))))
    # floor as a double: components far above the range of long stay whole numbers
    whole = F.transform("v", lambda c: F.when(F.abs(c * scale) < 2.0**52, F.floor(c * scale).cast("double")).otherwise(c * scale))
    return rows.select("id", F.size("v").cast("long").alias("dim"), whole.alias("x"))


def _near_pivot(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = shared.value
        for batch in batches:
            cell = np.zeros(len(batch), np.int64)
            for dim in batch["dim"].unique():
                own = np.flatnonzero(batch["dim"].to_numpy() == dim)
                p = pivots.get(int(dim))
                if p is not None and dim:
                    x = np.stack(batch["x"].to_numpy()[own])
                    cell[own] = (x @ p.T - (p * p).sum(1) / 2).argmax(1)
            yield batch.assign(cell=cell)

    return run


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """The ball tree of one shard: split at the median along the widest axis, down to leaves."""
    pdf = pdf.sort_values("id", kind="stable")
    dim = int(pdf["dim"].iloc[0])
    x = np.stack(pdf["x"].to_numpy()).astype(np.float64).reshape(len(pdf), dim)
    order = np.arange(len(x))
    lo, hi, left, right, centre, radius = [], [], [], [], [], []
    stack = [(0, len(x), -1, False)]
    while stack:
        a, b, parent, is_right = stack.pop()
        k = len(lo)
        if parent >= 0:
            (right if is_right else left)[parent] = k
        own = x[order[a:b]]
        c = own.mean(0)
        r = float(np.sqrt(((own - c) ** 2).sum(1).max()))
        lo.append(a), hi.append(b), left.append(-1), right.append(-1), centre.append(c), radius.append(r)
        if b - a > LEAF and r > 0:
            axis = int(np.ptp(own, axis=0).argmax())
            order[a:b] = order[a:b][np.argsort(own[:, axis], kind="stable")]
            mid = (a + b) // 2
            stack += [(a, mid, k, False), (mid, b, k, True)]
    return pd.DataFrame({
        "dim": [dim], "shard": [pdf["shard"].iloc[0]], "n": [len(x)], "ids": [pdf["id"].to_numpy(np.int64)[order].tobytes()], "x": [x[order].tobytes()],
        "nodes": [np.array([lo, hi, left, right], np.int64).tobytes()], "centre": [np.array(centre).tobytes()], "radius": [np.array(radius).tobytes()],
        "root": [centre[0].tolist()], "root_radius": [radius[0]],
    })


_SHARD_SCHEMA = "dim long, shard long, n long, ids binary, x binary, nodes binary, centre binary, radius binary, root array<double>, root_radius double"


def _bound(dot, norm, radius):
    """Upper bound of the inner product, a little above rounding errors."""
    b = dot + norm * radius
    return b + 1e-9 * (np.abs(dot) + norm * radius) + 1e-6


def _scores(x: np.ndarray, q: np.ndarray, largest: float) -> list[int]:
    if largest * largest * max(1, len(q)) <= EXACT:
        return (x @ q).astype(np.int64).tolist()
    whole = [int(v) for v in q.tolist()]
    top = (1 << 63) - 1  # beyond long: the nearest long
    return [max(-top - 1, min(top, sum(int(u) * v for u, v in zip(row.tolist(), whole)))) for row in x]


def _search(tree: dict, query: int, q: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
    """The shard's candidates for the query's best ``k``: (score, id), none below ``floor``."""
    norm = float(np.sqrt((q * q).sum()))
    bounds = _bound(tree["centre"] @ q, norm, tree["radius"])
    best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst on top
    heap = [(-float(bounds[0]), 0)]
    largest = max(tree["largest"], float(np.abs(q).max()) if len(q) else 0.0)
    while heap:
        up, node = heappop(heap)
        limit = best[0][0] if len(best) == k else None
        limit = floor if limit is None else limit if floor is None else max(limit, floor)
        if limit is not None and -up < limit:
            break
        if tree["left"][node] >= 0:
            for child in (int(tree["left"][node]), int(tree["right"][node])):
                heappush(heap, (-float(bounds[child]), child))
            continue
        a, b = int(tree["lo"][node]), int(tree["hi"][node])
        for score, i in zip(_scores(tree["x"][a:b], q, largest), tree["ids"][a:b].tolist()):
            if i != query and (floor is None or score >= floor):
                if len(best) < k:
                    heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heappop(best)
                    heappush(best, (score, -i))
    return [(s, -i) for s, i in best]


def _search_group(k: int):
    """One shard against a block of its queries."""

    def run(key, trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(trees) and len(queries):
            row = trees.iloc[0]
            n, dim = int(row["n"]), int(row["dim"])
            nodes = np.frombuffer(row["nodes"], np.int64).reshape(4, -1)
            x = np.frombuffer(row["x"], np.float64).reshape(n, dim)
            tree = {
                "lo": nodes[0], "hi": nodes[1], "left": nodes[2], "right": nodes[3], "x": x, "ids": np.frombuffer(row["ids"], np.int64),
                "centre": np.frombuffer(row["centre"], np.float64).reshape(-1, dim), "radius": np.frombuffer(row["radius"], np.float64),
                "largest": float(np.abs(x).max()) if x.size else 0.0,
            }
            for qid, q, floor in zip(queries["query_id"], queries["q"], queries["floor"]):
                out += [(int(qid), i, s) for s, i in _search(tree, int(qid), np.asarray(q, np.float64), k, None if pd.isna(floor) else int(floor))]
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype("int64")

    return run


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` rows of ``vectors`` with the highest inner products with each
    row of ``queries`` (rows of the same columns), less the query's own id; all if there are fewer.

    Components become floor(scale * component); scores are exact integers (beyond the range of long: the
    nearest long). Ties go to the smaller id, rank from 1. Rows with a null id, or a vector that is null or
    holds null or non-finite components, take no part, and vectors of different dimensions do not meet.
    Rows that repeat an id are candidates of their own; a query id that repeats is searched once per
    distinct vector and the best of them stay. Extra columns are not read; empty tables give empty ones.
    """
    spark = vectors.sparkSession
    ready(spark)
    rows = stored(quantised(vectors, id_col, vec_col, scale), "rows")
    asked = quantised(queries, id_col, vec_col, scale).select(F.col("id").alias("query_id"), "dim", F.col("x").alias("q")).distinct()
    asked = stored(asked, "queries")
    sizes = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n_dim"))
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(2.0 * PIVOTS * (1 << 30)) / F.col("n_dim")
    picked = rows.join(sizes.where(F.col("n_dim") > SHARD), "dim").where(chance).groupBy("dim").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("id").alias("h"), "x"))), 1, PIVOTS).alias("p"))
    pivots = {int(r["dim"]): np.array([p["x"] for p in r["p"]]) for r in picked.toLocalIterator()}
    celled = rows.mapInPandas(_near_pivot(spark.sparkContext.broadcast(pivots)), "id long, dim long, x array<double>, cell long")
    celled = stored(celled, "cells")
    # small cells together, large ones split: about SHARD rows to a shard
    cells = celled.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n_cell"))
    total = cells.groupBy("dim").agg(F.sum("n_cell").alias("n_dim"))
    cells = cells.join(total, "dim").withColumn("k", F.ceil(F.col("n_cell") / F.lit(SHARD))).withColumn("few", F.greatest(F.lit(1), F.ceil(F.col("n_dim") / F.lit(SHARD))))
    shard = F.when(F.col("n_cell") * 2 < SHARD, F.pmod(F.col("cell"), F.col("few")) + F.lit(1 << 48)).otherwise(F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), F.col("k"))).cast("long")
    sharded = celled.join(cells, ["dim", "cell"]).withColumn("shard", shard).select("id", "dim", "x", "shard")
    trees = stored(sharded.groupBy("dim", "shard").applyInPandas(_build, _SHARD_SCHEMA), "trees")

    roots = trees.select("dim", "shard", "root", "root_radius")
    dot = F.aggregate(F.zip_with("q", "root", lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(F.aggregate("q", F.lit(0.0), lambda s, v: s + v * v))
    # the query set against the shards, in blocks by dimension: one row per query and shard, without the shard's rows
    reach = asked.join(roots, "dim").select("query_id", "dim", "q", "shard", (dot + norm * F.col("root_radius")).alias("bound"), (F.abs(dot) + norm * F.col("root_radius")).alias("mass"))
    reach = stored(reach.select("query_id", "dim", "q", "shard", (F.col("bound") + 1e-9 * F.col("mass") + 1e-6).alias("bound")), "reach")
    first = reach.groupBy("query_id", "dim", "q").agg(F.max_by("shard", F.struct("bound", "shard")).alias("shard"))
    schema = "query_id long, id long, score long"
    blocks = ["dim", "shard"]
    seeds = first.withColumn("floor", F.lit(None).cast("long"))
    found = stored(trees.groupBy(*blocks).cogroup(seeds.groupBy(*blocks)).applyInPandas(_search_group(k), schema), "first")
    floors = found.groupBy("query_id", "id").agg(F.max("score").alias("score")).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k).select("query_id", "floor")
    rest = reach.join(first.select("query_id", "dim", "q", F.col("shard").alias("_first")), ["query_id", "dim", "q"]).where("shard <> _first")
    rest = rest.join(floors, "query_id", "left").where("floor is null or bound >= floor").select("query_id", "dim", "q", "shard", "floor")
    others = stored(trees.groupBy(*blocks).cogroup(rest.groupBy(*blocks)).applyInPandas(_search_group(k), schema), "others")
    from pyspark.sql import Window

    # at most k rows per query and shard reach this window
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    ranked = found.unionAll(others).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")
