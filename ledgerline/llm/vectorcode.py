"""Vector code compression: parts of a vector coded by the nearest entry of a codebook, entries searched by a GNAT.

Vectors are cut into consecutive parts with a codebook each. A codebook's entries stand in a geometric near-neighbour
access tree: a node has a few split points far from each other, every other entry goes to its nearest one, and the
node keeps for each (split point, child) the least and greatest distance from the split point to the child's entries.
A query that has distances to the split points drops every child whose entries must all be farther away than the
best entry so far: strictly farther, with distances rounded against the drop, so that ties survive. What remains is
decided on integer squared distances, ties by the lower index.

Codebooks are refined by rounds of assignment and averaging. Tasks send sums and counts per (part, entry, place);
the codebooks themselves, of a size that does not depend on the table, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from .common import lean, ready, stored

#: Split points of a node, and entries of a leaf.
DEGREE = 8
LEAF = 8
#: Components beyond this (after scaling) take the nearest value: below it, floors are exact in double precision.
LARGEST = 1 << 52
#: Parts that are searched at a time in a task.
BLOCK = 4_096
_LONG = (1 << 63) - 1


@dataclass
class Node:
    """Split points with their children; ``low[i, j]`` and ``high[i, j]`` bound the distance from split point i to
    what child j holds, its own split point included. A leaf has entries only."""

    entries: np.ndarray
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def squared(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer squared distances, rows of ``q`` by rows of ``x``: as doubles where those are exact, else as whole
    numbers of any size. Both are integers in arrays of int64."""
    top = max(int(np.abs(q).max(initial=0)), int(np.abs(x).max(initial=0)))
    if 4 * top * top * max(1, q.shape[1]) <= 1 << 53:
        a, b = q.astype(np.float64), x.astype(np.float64)
        return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)
    a, b = q.astype(object), x.astype(object)
    out = np.zeros((len(q), len(x)), object)
    for k in range(q.shape[1]):
        step = a[:, k][:, None] - b[:, k][None, :]
        out += step * step
    return out


def _root(d2: np.ndarray, up: bool) -> np.ndarray:
    """Square roots a little above or below the true ones."""
    d = np.sqrt(d2.astype(np.float64))
    return d * (1 + 1e-12) if up else d * (1 - 1e-12)


def gnat(entries: np.ndarray, members: np.ndarray | None = None) -> Node:
    """The tree over rows of ``entries`` (indices ``members``). Equal entries are one leaf, however many."""
    members = np.arange(len(entries)) if members is None else members
    if len(members) <= LEAF:
        return Node(members)
    d2 = squared(entries[members], entries[members[:1]])[:, 0]
    splits, near = [0], d2
    while len(splits) < DEGREE and near.max() > 0:
        splits.append(int(near.argmax()))  # the entry farthest from the split points so far
        near = np.minimum(near, squared(entries[members], entries[members[splits[-1:]]])[:, 0])
    if len(splits) == 1:
        return Node(members)
    d2 = squared(entries[members], entries[members[splits]])
    home = np.array([int(np.argmin(row)) for row in d2])
    node = Node(members[splits], low=np.empty((len(splits),) * 2), high=np.empty((len(splits),) * 2))
    rest = np.ones(len(members), bool)
    rest[splits] = False
    for j in range(len(splits)):
        own = home == j
        own[splits[j]] = True
        node.low[:, j] = _root(d2[own].min(0), up=False)
        node.high[:, j] = _root(d2[own].max(0), up=True)
        below = members[(home == j) & rest]
        node.children.append(gnat(entries, below) if len(below) else None)
    return node


class Search:
    """The nearest entry of many queries: ``best`` squared distances and ``index``, and how many distances it took."""

    def __init__(self, tree: Node, entries: np.ndarray, queries: np.ndarray):
        self.entries, self.queries = entries, queries
        self.index = np.zeros(len(queries), np.int64)
        self.best: np.ndarray | None = None
        self.distances = 0
        if len(entries) and len(queries):
            self._meet(np.arange(len(queries)), np.zeros(1, np.int64))
            self._descend(tree, np.arange(len(queries)))
            self._visit(tree, np.arange(len(queries)))

    def _meet(self, rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
        """Distances of some queries to some entries; the best are kept, ties to the lower index."""
        d2 = squared(self.queries[rows], self.entries[entries])
        self.distances += d2.size
        if self.best is None:
            self.best = d2[:, 0].copy()
            self.index[:] = entries[0]
        if d2.dtype == object and self.best.dtype != object:  # one block with components that doubles cannot square
            self.best = np.array([int(v) for v in self.best], object)
        order = np.argsort(entries, kind="stable")
        at = order[d2[:, order].argmin(1)]
        least = d2[np.arange(len(rows)), at]
        better = (least < self.best[rows]) | ((least == self.best[rows]) & (entries[at] < self.index[rows]))
        better = better.astype(bool)
        self.best[rows[better]] = least[better]
        self.index[rows[better]] = entries[at[better]]
        return d2

    def _descend(self, node: Node, rows: np.ndarray) -> None:
        """Each query down to the leaf of its nearest split points: a good first entry."""
        d2 = self._meet(rows, node.entries)
        if node.children:
            near = d2.argmin(1)
            for j, child in enumerate(node.children):
                if child is not None and (near == j).any():
                    self._descend(child, rows[near == j])

    def _visit(self, node: Node, rows: np.ndarray) -> None:
        d2 = self._meet(rows, node.entries)
        if not node.children:
            return
        low, high = _root(d2, up=False), _root(d2, up=True)
        for j, child in enumerate(node.children):
            if child is None:
                continue
            reach = _root(self.best[rows], up=True)
            # dropped only if some split point shows that every entry of the child is farther than the best
            gone = ((high + reach[:, None] < node.low[:, j]) | (low - reach[:, None] > node.high[:, j])).any(1)
            if not gone.all():
                alive = ~gone
                rows_j = rows[alive]
                self._visit(child, rows_j)


def cut(dim: int, parts: int) -> list[tuple[int, int]]:
    """Borders of the parts; where ``parts`` does not divide the dimension they differ by one in length."""
    return [(dim * p // parts, dim * (p + 1) // parts) for p in range(parts)]


def quantised(vectors: DataFrame, id_col: str, vec_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, x): floor(scale * component) as long; rows whose vector is null or holds null or non-finite
    components are dropped, components beyond ``LARGEST`` take the nearest value."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    top = float(LARGEST)
    return rows.select("id", "label", F.transform("v", lambda c: F.floor(F.greatest(F.lit(-top), F.least(F.lit(top), c * scale))).cast("long")).alias("x"))


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64, copy=False).reshape(len(column), dim)


def _assign(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, Search]]:
    """(batch, first row, part, the part's matrix, search) for blocks of rows and every part."""
    books, trees = shared.value, None
    for batch in batches:
        trees = trees or [gnat(b) for b in books]
        dim = sum(b.shape[1] for b in books)
        for at in range(0, batch.num_rows, BLOCK):
            x = _matrix(batch.slice(at, BLOCK).column("x"), dim)
            for p, (lo, hi) in enumerate(cut(dim, len(books))):
                own = np.ascontiguousarray(x[:, lo:hi])
                yield batch, at, p, own, Search(trees[p], books[p], own)


_SUMS = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("high", pa.list_(pa.int64())), ("low", pa.list_(pa.int64()))])


def _sums(shared):
    """One task's counts and component sums per part and entry; a sum goes as two longs, neither of which overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        n = [np.zeros(len(b), np.int64) for b in books]
        high = [np.zeros(b.shape, np.int64) for b in books]
        low = [np.zeros(b.shape, np.int64) for b in books]
        for _, _, p, own, found in _assign(shared, batches):
            np.add.at(n[p], found.index, 1)
            np.add.at(high[p], found.index, own >> 32)
            np.add.at(low[p], found.index, own & 0xFFFFFFFF)
        rows = [(p, e, int(n[p][e]), high[p][e], low[p][e]) for p in range(len(books)) for e in np.flatnonzero(n[p])]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), _SUMS)], schema=_SUMS)

    return run


def _coded(shared, id_type: pa.DataType):
    schema = pa.schema([("id", id_type), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = len(shared.value)
        codes, errors = [], []
        for batch, at, p, _, found in _assign(shared, batches):
            codes.append(found.index)
            errors.append([int(v) for v in found.best])
            if p == parts - 1:
                piece = batch.slice(at, BLOCK)
                code = ["".join(f"{int(i):02x}" for i in row) for row in zip(*codes)]
                error = [min(sum(row), _LONG) for row in zip(*errors)]
                yield pa.RecordBatch.from_arrays([piece.column("id"), piece.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], schema=schema)
                codes, errors = [], []

    return run


@dataclass
class Coded:
    """``rows``: (id, label, code, error); ``codebooks``: per part an array of entries."""

    rows: DataFrame
    codebooks: list[np.ndarray]

    def codebooks_sha256(self) -> str:
        """Digest of all entries' components, by part, entry and position, as decimal text joined by commas."""
        return hashlib.sha256(",".join(str(int(v)) for b in self.codebooks for v in b.ravel()).encode()).hexdigest()

    def with_label_errors(self) -> DataFrame:
        """``rows`` with the errors summed over equal labels, nulls together (beyond long: the largest long)."""
        total = F.sum(F.col("error").cast("decimal(38,0)"))
        sums = stored(self.rows.groupBy("label").agg(F.least(total, F.lit(_LONG).cast("decimal(38,0)")).cast("long").alias("label_error")), "label_errors")
        sums = sums.withColumnRenamed("label", "_l")
        return join_bounded(self.rows, sums, F.col("label").eqNullSafe(F.col("_l"))).drop("_l")


def compress(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> Coded:
    """Codes of all vectors. The codebooks begin as the parts of the ``entries`` smallest ids' vectors (of rows that
    share an id the smaller vector first; a null id comes last) and are refined ``rounds`` times: every part goes to
    its nearest entry, every entry that has parts becomes their componentwise floor(sum / count).

    Rows whose vector is null or holds null or non-finite components are dropped, and so are those of another
    dimension than the smallest id's; rows with a null id or label and repeated rows are coded like any other. A
    dimension that ``parts`` does not divide is cut into parts that differ by one. Components are bounded by 2^52
    (after scaling). Extra columns are not read; an empty table gives no rows and empty codebooks.
    """
    spark = vectors.sparkSession
    ready(spark)
    if not 0 < entries <= 256:
        raise ValueError("an entry's index has two hex digits: 1 to 256 entries")
    rows = stored(quantised(vectors, id_col, vec_col, label_col, scale), "vectors")
    # a top-k: 256 rows of each task, and of all
    lead = rows.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(1).collect()
    dim = len(lead[0]["x"]) if lead else 0
    rows = rows.where(F.size("x") == dim)
    head = rows.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    start = np.array([r["x"] for r in head], np.int64).reshape(len(head), dim)
    books = [np.ascontiguousarray(start[:, lo:hi]) for lo, hi in cut(dim, parts)]
    for _ in range(rounds if head else 0):
        shared = spark.sparkContext.broadcast(books)
        sums = rows.select("x").mapInArrow(lean(_sums(shared)), "part int, entry int, n long, high array<long>, low array<long>")
        each = sums.select("part", "entry", "n", F.posexplode_outer(F.arrays_zip("high", "low")).alias("place", "s"))
        total = each.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s.high").alias("high"), F.sum("s.low").alias("low"))
        # at most parts * entries * width rows, whatever the table
        for r in total.where("place is not null").collect():
            books[r["part"]][r["entry"], r["place"]] = ((int(r["high"]) << 32) + int(r["low"])) // int(r["n"])
        shared.unpersist()
    shared = spark.sparkContext.broadcast(books)
    coded = rows.mapInArrow(lean(_coded(shared, pa.int64())), "id long, label string, code string, error long")
    return Coded(stored(coded, "coded"), books)
