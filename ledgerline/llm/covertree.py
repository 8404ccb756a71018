"""Embedding near-dedup: cover-tree dual traversal for all pairs above a cosine threshold.

Unit vectors of one label (and one dimension) are dealt to shards of at most about ``SHARD`` vectors. The
deal follows pivots: each vector goes to the nearest of a few pivots of its label, and a cell with more
vectors than a shard holds is split by hash, so near vectors meet in few shards and no label, however hot, is
one task. One task per shard builds its cover tree: nested levels with halving radii (Euclidean distance of
unit vectors), kept as flat arrays: the vectors in depth-first order and, per node, its range, centre, level
and covering radius.

Shard pairs of a label are joined on the label, less those whose root balls are too far apart. One task per
pair walks both trees at once: a pair of nodes is dropped when its distance less both radii exceeds the
threshold distance, counted whole when its distance plus both radii is within, and opened otherwise; leaves
are compared exactly in double precision. A task returns, per vector with links, how many it has and one vector
of the same group (a spanning forest of the links), so pairs are never listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, ready, stored

SHARD = 2_048
#: Most pivots of one label; they are rows of the label chosen by hash.
PIVOTS = 32
#: Nodes with at most this many vectors are leaves.
LEAF = 48
#: Slack of the radius bounds, far above rounding: pairs within it are decided exactly.
SLACK = 1e-7


def usable(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, x): vectors that can link: not null, some component not zero, all components finite."""
    x = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), x.alias("x"))
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return rows.where("id is not null and label is not null and x is not null").where(~bad & F.exists("x", lambda v: v != 0))


class Tree:
    """A cover tree as arrays. ``order``: vectors depth first; node k covers order[lo[k]:hi[k]], its centre is
    order[lo[k]], ``radius`` bounds the distance from the centre to all it covers, children follow in ``kids``."""

    def __init__(self, x: np.ndarray):
        self.lo, self.hi, self.radius, self.kids = [], [], [], []
        self.order = np.empty(len(x), np.int64)
        self.at = 0
        if len(x):
            self._grow(x, np.arange(len(x)), np.sqrt(np.maximum(0, ((x - x[0]) ** 2).sum(1))))

    def _grow(self, x: np.ndarray, root_members: np.ndarray, root_dist: np.ndarray) -> None:
        # a stack in place of recursion: copies of one vector could nest levels deep
        stack = [(root_members, root_dist, None)]
        while stack:
            members, dist, parent = stack.pop()
            k = len(self.lo)
            self.lo.append(self.at)
            self.hi.append(self.at + len(members))
            self.radius.append(float(dist.max()))
            self.kids.append([])
            if parent is not None:
                self.kids[parent].append(k)
            if len(members) <= LEAF or self.radius[k] <= SLACK:
                self.order[self.at : self.at + len(members)] = members
                self.at += len(members)
                continue
            # the next level: centres at least half the radius apart, every member with its nearest centre.
            # The centre of this node comes first, so it is the centre of its first child too.
            half = self.radius[k] / 2
            near, owner = dist.copy(), np.zeros(len(members), np.int64)
            centres = 0
            while True:
                far = int(near.argmax())
                if near[far] <= half:
                    break
                centres += 1
                d = np.sqrt(np.maximum(0, ((x[members] - x[members[far]]) ** 2).sum(1)))
                closer = d < near
                closer[far] = True
                near[closer], owner[closer] = d[closer], centres
            groups = []
            for c in range(centres + 1):
                own = np.flatnonzero(owner == c)
                if len(own):
                    own = own[np.argsort(near[own], kind="stable")]  # the centre, at distance 0, first
                    groups.append((members[own], near[own], k))
            stack.extend(reversed(groups))


def _pivots_assign(shared):
    """Adds the nearest pivot of the label to each row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pivots = shared.value
        for batch in batches:
            x = batch["x"].to_numpy()
            keys = list(zip(batch["label"], batch["dim"]))
            cell = np.zeros(len(batch), np.int64)
            for key in set(keys):
                own = np.flatnonzero([k == key for k in keys])
                p = pivots.get(key)
                if p is not None:
                    u = np.stack(x[own])
                    cell[own] = (u @ p.T).argmax(1)
            yield batch.assign(cell=cell)

    return run


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow of squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    """One shard: its tree in bytes, and the ball of its root."""
    pdf = pdf.sort_values("id", kind="stable")
    raw = np.stack(pdf["x"].to_numpy()).astype(np.float64)
    x = _unit(raw)
    t = Tree(x)
    kids = np.array([c for k in t.kids for c in k], np.int64)
    kid_end = np.cumsum([len(k) for k in t.kids]).astype(np.int64)
    return pd.DataFrame({
        "label": [pdf["label"].iloc[0]], "dim": [pdf["dim"].iloc[0]], "shard": [pdf["shard"].iloc[0]], "n": [len(x)],
        "ids": [pdf["id"].to_numpy(np.int64)[t.order].tobytes()], "x": [x[t.order].tobytes()], "raw": [raw[t.order].tobytes()],
        "lo": [np.array(t.lo, np.int64).tobytes()], "hi": [np.array(t.hi, np.int64).tobytes()], "radius": [np.array(t.radius).tobytes()],
        "kids": [kids.tobytes()], "kid_end": [kid_end.tobytes()], "root": [x[t.order[0]].tolist()], "root_radius": [float(t.radius[0])],
    })


_SHARD_SCHEMA = "label string, dim long, shard long, n long, ids binary, x binary, raw binary, lo binary, hi binary, radius binary, kids binary, kid_end binary, root array<double>, root_radius double"


class _Flat:
    """A stored tree."""

    def __init__(self, row, side: str):
        get = lambda name, kind: np.frombuffer(row[side + name], kind)
        self.n, self.dim = int(row[side + "n"]), int(row["dim"])
        self.ids = get("ids", np.int64)
        self.x = get("x", np.float64).reshape(self.n, self.dim)
        self.raw = get("raw", np.float64).reshape(self.n, self.dim)
        self.norm = np.sqrt((self.raw * self.raw).sum(1))
        self.lo, self.hi, self.radius = get("lo", np.int64), get("hi", np.int64), get("radius", np.float64)
        ends = get("kid_end", np.int64)
        self.kids = np.split(get("kids", np.int64), ends[:-1]) if len(ends) else []
        self.centre = self.x[self.lo]


class _Links:
    """Link counts per vector of two shards, and a forest of the links (union by smaller root)."""

    def __init__(self, n: int):
        self.count = np.zeros(n, np.int64)
        self.up = np.arange(n)

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _apart(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Distances of the unit vectors in the rows of ``u`` and ``v``."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (u @ v.T)))


def _walk(a: _Flat, b: _Flat, same: bool, threshold: float) -> _Links:
    """Both trees from their roots; vectors of ``b`` are numbered after those of ``a`` (the same ones if ``same``).

    Opening a pair of nodes compares all children at once and stacks those within reach only. Nodes of
    like radius are opened together, otherwise the wider one.
    """
    shift = 0 if same else a.n
    links = _Links(a.n + (0 if same else b.n))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    stack = [(0, 0, 0.0 if same else float(_apart(a.centre[:1], b.centre[:1])[0, 0]))]
    while stack:
        p, q, gap = stack.pop()
        wide = float(a.radius[p] + b.radius[q])
        if gap - wide > reach + SLACK:
            continue
        la, ha, lb, hb = int(a.lo[p]), int(a.hi[p]), int(b.lo[q]), int(b.hi[q])
        own = same and p == q
        # all pairs are within reach: two members of one node are at most two radii apart
        if gap + wide < reach - SLACK:
            if own:
                links.count[la:ha] += ha - la - 1
                for i in range(la + 1, ha):
                    links.join(la, i)
            else:
                links.count[la:ha] += hb - lb
                links.count[shift + lb : shift + hb] += ha - la
                for i in range(la, ha):
                    links.join(i, shift + lb)
                for j in range(lb, hb):
                    links.join(la, shift + j)
            continue
        ka, kb = a.kids[p], b.kids[q]
        if len(ka) or len(kb):
            # a side that is not opened stands for itself
            narrow_a = not len(ka) or (len(kb) > 0 and not own and 2 * a.radius[p] < b.radius[q])
            narrow_b = not len(kb) or (len(ka) > 0 and not own and 2 * b.radius[q] < a.radius[p])
            left = np.array([p]) if narrow_a else ka
            right = np.array([q]) if narrow_b else kb
            gaps = _apart(a.centre[left], b.centre[right])
            close = gaps - a.radius[left][:, None] - b.radius[right][None, :] <= reach + SLACK
            if own:
                np.fill_diagonal(gaps, 0.0)
                np.fill_diagonal(close, True)
                close = np.triu(close)
            i, j = np.nonzero(close)
            stack.extend(zip(left[i].tolist(), right[j].tolist(), gaps[i, j].tolist()))
            continue
        # as the plain definition has it: dot product over the product of the norms, in double precision
        cos = (a.raw[la:ha] @ b.raw[lb:hb].T) / (a.norm[la:ha, None] * b.norm[None, lb:hb])
        unsure = ~np.isfinite(cos)
        if unsure.any():
            cos[unsure] = (a.x[la:ha] @ b.x[lb:hb].T)[unsure]
        hit = cos >= threshold
        if own:
            np.fill_diagonal(hit, False)
        if not hit.any():
            continue
        links.count[la:ha] += hit.sum(1)
        if not own:
            links.count[shift + lb : shift + hb] += hit.sum(0)
        rows, cols = np.flatnonzero(hit.any(1)), np.flatnonzero(hit.any(0))
        ra = np.array([links.root(la + int(i)) for i in rows])
        rb = np.array([links.root(shift + lb + int(j)) for j in cols])
        for i, j in zip(*np.nonzero(hit[np.ix_(rows, cols)] & (ra[:, None] != rb[None, :]))):
            links.join(la + int(rows[i]), shift + lb + int(cols[j]))
    return links


def _pair_rows(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                same = row["a_shard"] == row["b_shard"]
                a = _Flat(row, "a_")
                b = a if same else _Flat(row, "b_")
                links = _walk(a, b, same, threshold)
                ids = a.ids if same else np.concatenate([a.ids, b.ids])
                some = np.flatnonzero(links.count)
                yield pd.DataFrame({"id": ids[some], "links": links.count[some], "peer": ids[[links.root(int(i)) for i in some]] if len(some) else np.empty(0, np.int64)})

    return run


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """(id, n_links, comp) of every row: its direct links, and the smallest id reachable.

    Vectors link when their labels are equal and not null and their cosine is at least ``threshold``, in
    double precision. Vectors that are null, empty, zero, or hold null or non-finite components, or whose
    dimensions differ, link with nothing; neither do rows with a null id (comp null). Rows that repeat an
    id are vectors of their own that share it: their links add up in each of their rows. Ties do not
    arise. Extra columns are not read; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    ready(spark)
    rows = usable(vectors, id_col, vec_col, label_col).withColumn("dim", F.size("x").cast("long"))
    rows = stored(rows, "vectors")
    sizes = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n_label"))
    # a few pivots for labels of more than a shard: the rows with the smallest hash of the id
    big = sizes.where(F.col("n_label") > SHARD)
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(2.0 * PIVOTS * (1 << 30)) / F.col("n_label")
    picked = rows.join(big, ["label", "dim"]).where(chance).groupBy("label", "dim").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("id").alias("h"), "x"))), 1, PIVOTS).alias("p"))
    # one bounded row per label; a label's row is 32 pivots at most
    pivots = {(r["label"], r["dim"]): _unit(np.array([p["x"] for p in r["p"]])) for r in picked.toLocalIterator()}
    shared = spark.sparkContext.broadcast(pivots)
    celled = rows.mapInPandas(_pivots_assign(shared), "id long, label string, x array<double>, dim long, cell long")
    celled = stored(celled, "cells")
    split = celled.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(SHARD)).cast("long").alias("k"))
    shard = F.col("cell") * F.lit(1 << 32) + F.pmod(F.xxhash64("id"), F.col("k"))
    sharded = celled.join(F.broadcast(split) if split.count() <= 100_000 else split, ["label", "dim", "cell"]).withColumn("shard", shard)
    trees = stored(sharded.select("id", "label", "x", "dim", "shard").groupBy("label", "dim", "shard").applyInPandas(_build, _SHARD_SCHEMA), "trees")

    names = [c for c in trees.columns if c not in ("label", "dim")]
    a = trees.select("label", "dim", *[F.col(c).alias("a_" + c) for c in names])
    b = trees.select("label", "dim", *[F.col(c).alias("b_" + c) for c in names])
    # root balls too far apart never meet
    gap = F.sqrt(F.aggregate(F.zip_with("a_root", "b_root", lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))
    reach = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    pairs = a.join(b, ["label", "dim"]).where("a_shard <= b_shard").where(gap <= F.col("a_root_radius") + F.col("b_root_radius") + F.lit(reach + 1e-6))
    pairs = pairs.drop("a_root", "b_root")
    found = stored(pairs.repartition(F.xxhash64("label", "a_shard", "b_shard")).mapInPandas(_pair_rows(threshold), "id long, links long, peer long"), "found")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("peer").alias("b")))
    ids = vectors.select(F.col(id_col).cast("long").alias("id"))
    out = ids.join(counted, "id", "left").join(groups.withColumnRenamed("node", "id"), "id", "left")
    return out.select("id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("comp", "id").alias("comp"))
