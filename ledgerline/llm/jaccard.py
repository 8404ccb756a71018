"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures, then exact intersection.

Two documents link when ``100 * |A & B| >= 75 * |A | B|`` over their sets of word shingles. Sets are
sorted arrays of 64-bit shingle hashes. The work is laid out so that no step grows with the square of
a group of copies and none is cut short:

1. Equal sets are one class (a 128-bit digest of the array and its size); only classes are joined.
2. Sets that reach the threshold share at least ``l`` shingles within the first ``n - ceil(.75 n) + l`` of any
   common order (``l = 1 + n // 20``, by the smaller set). Frequent shingles, by hashed counters over all documents,
   are ordered last (this changes cost only, any order is exact). Shingles that only one class lists
   vanish in a partial aggregate, and with them classes that are left with too few.
3. Classes that share a shingle with one smallest class are a group, and a class is listed once in it. Members of a
   group in the same or neighbouring size bands (powers of 4/3) meet in tiles of bounded rows and bytes. The number of bits that
   one bitmap has and the other lacks bounds the overlap from above. A first pass returns the members, not the pairs, that
   have a partner whom the bitmaps allow.
4. A second pass sends the sorted arrays of these members to the same tiles and intersects them exactly there. A pair that
   shares several groups belongs to the smallest. So every link is found, and counted once; what leaves a tile
   is a count per member and a spanning forest, so no table holds the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from . import words
from .common import components, hot_join, lean, ready, scratch, stored

#: Counters of the documents that hold a shingle (a power of two; shingles may share one), and how many of them a task sends at once.
COUNTERS, BLOCK = 1 << 20, 1 << 16
#: Frequent: in so many documents, and one in so many of all, above what a counter holds on average.
FREQUENT, FREQUENT_SHARE = 8, 2500
#: Members and bytes of one side of a tile, about: more make more sides (one set may be larger).
TILE, TILE_BYTES = 2048, 32 << 20
#: The key of a tile, and of a class: the smallest id of a set's documents; ``d1`` tells apart the texts of one id.
TILE_KEY, CLASS = ["p", "lo", "s1", "s2"], ["id", "d1"]


def _shingles(raw: np.ndarray, off: np.ndarray, width: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles."""
    raw = words.fold_case(raw)
    starts, ends, first = words.words_of(raw, off)
    h = words.span_hashes(raw, starts, ends)
    odd = np.uint64(0xA0761D6478BD642F)
    rolled = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for k in range(width):
        rolled = words.mix(rolled * odd + h[k : k + len(rolled)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]).view(np.int64))
        elif b > a:
            one = np.uint64([b - a])
            for k in range(a, b):
                one = words.mix(one * odd + h[k : k + 1])
            out.append(one.view(np.int64))
        else:
            out.append(np.empty(0, np.int64))
    return out


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    off = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=off[1:])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(off), pa.array(flat))


def _sum(s: np.ndarray, odd: int = 0) -> int:
    """One half of a set's digest."""
    return int(words.mix(s.view(np.uint64) ^ np.uint64(odd)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0


def _shingle_rows(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw, off in words.text_slices(batch.column(1)):
                sets = _shingles(raw, off, width)
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array([_sum(s) for s in sets], pa.int64()), _lists(sets)], ["id", "d1", "s"])

    return run


def _least_common(n):
    """How many shingles the prefixes of a linked pair have in common at least, by the smaller size."""
    return 1 + n // 20


def _sketch_rows(width: int, percent: int, frequent):
    """Per text: its set's size, digest, bitmap, and prefix in the common order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot = _unpacked(frequent.value)
        for batch in batches:
            for a, b, raw, off in words.text_slices(batch.column(1)):
                sets = _shingles(raw, off, width)
                d1, d2, prefix = [], [], []
                for s in sets:
                    d1.append(_sum(s))
                    d2.append(_sum(s, 0x2545F4914F6CDD1D))
                    keep = len(s) - (percent * len(s) + 99) // 100 + _least_common(len(s)) if len(s) else 0
                    is_hot = hot[_counter(s)]
                    s = np.concatenate([s[~is_hot], s[is_hot]])
                    prefix.append(s[:keep])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], pa.array([len(s) for s in sets], pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
                     pa.array([_bits(s) for s in sets], pa.binary()), _lists(prefix)],
                    ["id", "n", "d1", "d2", "bits", "prefix"],
                )

    return run


def _bits(s: np.ndarray) -> bytes:
    """A bitmap of a power of two bits, about four per element: bit = low bits of the scrambled hash."""
    size = max(64, 1 << int(4 * len(s) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[words.mix(s.view(np.uint64)) & np.uint64(size - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _folded(b: bytes, size: int) -> np.ndarray:
    """The bitmap at a smaller power of two of bytes: its halves laid over one another."""
    x = np.frombuffer(b, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    return x


def _reaches(overlap, nx, ny, percent: int):
    return 100 * overlap >= percent * (nx + ny - overlap)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list column."""
    off = column.offsets.to_numpy()
    return column.values.to_numpy()[off[0] : off[-1]], off - off[0]


def _picked(flat: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The values of some rows, one after the other, and where each row's begin (and the last one's end)."""
    size = off[rows + 1] - off[rows]
    begin = np.concatenate([[0], np.cumsum(size)])
    return flat[np.arange(begin[-1]) + np.repeat(off[rows] - begin[:-1], size)], begin


class _Tile:
    """Members of a tile as arrays. Pairs are formed within a side only in the tile of a side with itself, and only
    if one of the two lies in band ``lo``; a pair of one id is none."""

    def __init__(self, key: tuple, rows: pa.Table, percent: int):
        self.p, self.lo, self.percent, self.same = key[0], key[1], percent, key[2] == key[3]
        column = lambda c: rows.column(c).combine_chunks()
        self.band, self.side, self.ids, self.n = (column(c).to_numpy() for c in ("band", "side", "id", "n"))
        groups, self.group_off = _flat(column("ps"))
        known, codes = np.unique(groups, return_inverse=True)
        self.groups, self.group_flag = codes, np.zeros(len(known) + 1, np.int64)
        self.earlier = known < self.p
        if "s" in rows.column_names:
            flat, self.set_off = _flat(column("s"))
            self.ranks = np.unique(flat, return_inverse=True)[1]
            self.set_flag = np.zeros(len(flat) + 1, bool)
            bits = [_bits(flat[a:b]) for a, b in zip(self.set_off[:-1], self.set_off[1:])]
        else:
            bits = column("bits").to_pylist()
        size = min(len(b) for b in bits)
        self.bits = np.stack([_folded(b, size) for b in bits])
        self.held = np.bitwise_count(self.bits).sum(1, dtype=np.int64)

    def allowed(self, i: int, wanted: np.ndarray | None = None) -> np.ndarray:
        """Rows behind ``i`` that the bitmaps allow beside it: each bit that only one has is an element the other lacks."""
        n, low = self.n, self.band == self.lo
        ok = (low[i + 1 :] | low[i]) & (100 * np.minimum(n[i + 1 :], n[i]) >= self.percent * np.maximum(n[i + 1 :], n[i])) & (self.ids[i + 1 :] != self.ids[i])
        if not self.same:
            ok &= self.side[i + 1 :] != self.side[i]
        if wanted is not None:
            ok &= wanted[i + 1 :]
        j = np.flatnonzero(ok) + i + 1
        if len(j):
            both = np.bitwise_count(self.bits[i] & self.bits[j]).sum(1, dtype=np.int64)
            j = j[_reaches(np.minimum(n[i] - self.held[i], n[j] - self.held[j]) + both, n[i], n[j], self.percent)]
        own = self.groups[self.group_off[i] : self.group_off[i + 1]]
        own = own[self.earlier[own]]
        if len(j) and len(own):  # pairs of an earlier group are that group's
            self.group_flag[own] = 1
            theirs, begin = _picked(self.groups, self.group_off, j)
            seen = np.concatenate([[0], np.cumsum(self.group_flag[theirs])])
            self.group_flag[own] = 0
            j = j[seen[begin[1:]] == seen[begin[:-1]]]
        return j

    def linked(self, i: int) -> np.ndarray:
        """Rows behind ``i`` whose sorted arrays reach the threshold with its own."""
        j = self.allowed(i)
        if not len(j):
            return j
        own = self.ranks[self.set_off[i] : self.set_off[i + 1]]
        self.set_flag[own] = True
        theirs, begin = _picked(self.ranks, self.set_off, j)
        overlap = np.add.reduceat(self.set_flag[theirs], begin[:-1], dtype=np.int64)
        self.set_flag[own] = False
        return j[_reaches(overlap, self.n[i], self.n[j], self.percent)]


def _tiled(work, names: list[str]):
    """``work(key, rows)`` for each tile of a task whose rows are sorted by tile; it returns a list of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            out = []
            if batch.num_rows:
                keys = np.stack([batch.column(c).to_numpy() for c in TILE_KEY])
                cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1
                edges = [0, *cuts.tolist(), batch.num_rows]
                for a, b in zip(edges[:-1], edges[1:]):
                    at = tuple(keys[:, a].tolist())
                    if held and at != key:
                        out.append(work(key, pa.Table.from_batches(held)))
                        held = []
                    key = at
                    held.append(batch.slice(a, b - a))
            yield from _one_batch(out, names)
        if held:
            yield from _one_batch([work(key, pa.Table.from_batches(held))], names)

    return run


def _one_batch(parts: list[list[np.ndarray]], names: list[str]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts)], names)


def _partnered(percent: int):
    """First pass: the members of a tile that have a partner whom the bitmaps allow."""

    def work(key: tuple, rows: pa.Table) -> list[np.ndarray]:
        tile, d1 = _Tile(key, rows, percent), rows.column("d1").to_numpy()
        some = np.zeros(len(tile.ids), bool)
        for i in range(len(some) - 1):
            j = tile.allowed(i, ~some if some[i] else None)
            some[j] = True
            some[i] |= len(j) > 0
        found = np.flatnonzero(some)
        return [*[np.full(len(found), k, np.int64) for k in key], tile.band[found], tile.side[found], tile.ids[found], d1[found], tile.n[found]]

    return _tiled(work, [*TILE_KEY, "band", "side", *CLASS, "n"])


def _linked(percent: int):
    """Second pass: (id, d1, links) of the members that link, and (id, other) of a spanning forest of their links."""

    def work(key: tuple, rows: pa.Table) -> list[np.ndarray]:
        tile, d1 = _Tile(key, rows, percent), rows.column("d1").to_numpy()
        ids, count, group, forest = tile.ids, np.zeros(len(d1), np.int64), np.arange(len(d1)), []
        for i in range(len(ids) - 1):
            j = tile.linked(i)
            count[i] += len(j)
            count[j] += 1
            met, at = np.unique(group[j], return_index=True)
            apart = met != group[i]
            if apart.any():
                forest.append(np.stack([np.full(apart.sum(), ids[i]), ids[j[at[apart]]]]))
                group[np.isin(group, met[apart])] = group[i]
        some = np.flatnonzero(count)
        a, b = np.concatenate(forest, axis=1) if forest else np.empty((2, 0), np.int64)
        return [np.concatenate([ids[some], a]), np.concatenate([d1[some], np.zeros_like(a)]), np.concatenate([count[some], np.zeros_like(a)]), np.concatenate([ids[some], b])]

    return _tiled(work, [*CLASS, "links", "other"])


def _counter(s: np.ndarray) -> np.ndarray:
    """The counter of each shingle hash."""
    return (s.view(np.uint64) & np.uint64(COUNTERS - 1)).astype(np.int64)


def _unpacked(bits: bytes) -> np.ndarray:
    """A flag per counter."""
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)


def _count_rows(width: int):
    """Per task, in blocks of counters: how many of its texts' sets hold a shingle of each counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.uint32)
        for batch in batches:
            for _, _, raw, off in words.text_slices(batch.column(0)):
                np.add.at(counts, _counter(np.concatenate(_shingles(raw, off, width))), 1)
        for k, block in enumerate(counts.reshape(-1, BLOCK)):
            if block.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([block.tobytes()], pa.binary())], ["block", "counts"])

    return run


def _frequent_rows(least: int):
    """Sums the blocks of all tasks; per block, a bit for each counter that exceeds the block's mean by ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        for k, block in sums.items():
            bits = np.packbits(block >= block.mean() + least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([bits], pa.binary())], ["block", "bits"])

    return run


def _frequent(texts: DataFrame, n_docs: int, width: int) -> bytes:
    """A bit per counter of shingles: whether it is of frequent ones. Every document is counted, in memory that does
    not depend on their number; a rare shingle that shares a frequent one's counter counts as frequent, for all sets alike."""
    least = max(FREQUENT, n_docs // FREQUENT_SHARE)
    blocks = texts.select("text").mapInArrow(lean(_count_rows(width)), "block int, counts binary").repartition(COUNTERS // BLOCK, "block")
    out = np.zeros(COUNTERS // 8, np.uint8)
    for r in blocks.mapInArrow(lean(_frequent_rows(least)), "block int, bits binary").collect():  # 128 KB, whatever the input
        out[r["block"] * BLOCK // 8 : (r["block"] + 1) * BLOCK // 8] = np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


class Joined:
    """``members``: id, n (set size), class_id, d1; ``degrees``: id, d1, links (to other classes) of the classes that have
    any; ``links``: a, b, which span each component; ``groups``: node, comp."""

    def __init__(self, members: DataFrame, degrees: DataFrame, links: DataFrame, groups: DataFrame):
        self.members, self.degrees, self.links, self.groups = members, degrees, links, groups

    def documents(self) -> DataFrame:
        """id, n, class_id, n_links (other classes that its class links to), comp: one row per document with an id."""
        classes = self.members.groupBy("class_id", "d1").agg(F.count(F.lit(1)).alias("c"))
        named = classes.join(self.degrees.withColumnRenamed("id", "class_id"), ["class_id", "d1"], "left").join(self.groups.withColumnRenamed("node", "class_id"), "class_id", "left")
        rows = hot_join(self.members, stored(named.select("class_id", "d1", "links", "comp", "c"), "named"), ["class_id", "d1"])
        return rows.select("id", "n", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("comp", "class_id").alias("comp"))


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75) -> Joined:
    """Links of documents by the Jaccard similarity of their word shingles, see the module.

    A null or empty text, or one of white space only, has the empty set and links with nothing. Fewer
    words than ``width`` make one shingle. Rows with a null id take no part. Rows that repeat an id are
    one node: their texts' links are its links (``members`` still has a row for each, with the links of its own text;
    texts of one id do not link with each other). Ties do not
    arise: a class and a component are named by their smallest id. Other columns are not read.
    """
    spark = docs.sparkSession
    ready(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    with scratch(spark):
        return _joined(texts, width, percent)


def _joined(texts: DataFrame, width: int, percent: int) -> Joined:
    spark = texts.sparkSession
    hot = spark.sparkContext.broadcast(_frequent(texts, texts.select("id").count(), width))
    sketch = stored(texts.mapInArrow(lean(_sketch_rows(width, percent, hot)), "id long, n long, d1 long, d2 long, bits binary, prefix array<long>"), "sketch")

    digest = ["n", "d1", "d2"]
    some = sketch.where("n > 0").select("id", *digest)
    classes = stored(some.groupBy(*digest).agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("c")), "classes")
    empty = sketch.where("n = 0").select("id", "n", F.col("id").alias("class_id"), "d1")
    members = stored(hot_join(some, classes, digest).select("id", "n", "class_id", "d1").unionAll(empty), "members", keep=True)
    # one row per class and shingle: copies agree on the prefix, so only the representative's is listed
    reps = stored(classes.select(F.col("class_id").alias("id"), "d1"), "representatives")
    listed = join_bounded(sketch.select(*CLASS, "n", "prefix"), reps, CLASS, "left_semi").select(*CLASS, "n", F.explode("prefix").alias("t")).repartition("t")
    common = listed.groupBy("t").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo <> hi").select("t")
    shared = stored(listed.join(common, "t", "left_semi"), "shared")
    # a linked class has enough common shingles: others, that share a line or a passage only, go
    smallest = F.ceil(F.col("n") * F.lit(percent) / 100)
    enough = shared.groupBy(*CLASS, "n").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= 1 + F.floor(smallest / 20)).select(*CLASS)
    rest = stored(shared.join(enough, CLASS, "left_semi"), "shared")
    first = stored(rest.groupBy("t").agg(F.min("id").alias("p"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("c")).where("p <> hi").drop("hi"), "groups")
    grouped = stored(hot_join(rest, first, ["t"]).select("p", *CLASS, "n").distinct(), "grouped")

    of = grouped.groupBy(*CLASS).agg(F.array_sort(F.collect_list("p")).alias("ps"))
    bitmaps = join_bounded(sketch.select(*CLASS, "bits"), stored(grouped.select(*CLASS).distinct(), "wanted"), CLASS, "left_semi").dropDuplicates(CLASS)
    slim = _tile_members(grouped, percent)
    tiles = lambda rows: rows.repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
    schema = "p long, lo long, s1 long, s2 long, band long, side long, id long, d1 long, n long"
    partnered = tiles(slim.join(stored(bitmaps.join(of, CLASS), "bitmaps"), CLASS)).mapInArrow(lean(_partnered(percent)), schema)
    partnered = stored(partnered, "partnered")
    # sorted arrays are made from the texts again, for these members only: they are much larger than all else and few are needed
    ends = stored(partnered.select(*CLASS).distinct(), "ends")
    ids = stored(ends.select("id").distinct(), "ends")
    sets = join_bounded(texts, ids, ["id"], "left_semi").mapInArrow(lean(_shingle_rows(width)), "id long, d1 long, s array<long>")
    sets = stored(join_bounded(sets, ends, CLASS, "left_semi").dropDuplicates(CLASS).join(of, CLASS), "sets")
    found = stored(tiles(partnered.join(sets, CLASS)).mapInArrow(lean(_linked(percent)), "id long, d1 long, links long, other long"), "links", keep=True)

    degrees = found.where("links > 0").groupBy(*CLASS).agg(F.sum("links").alias("links"))
    links = found.where("links = 0").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
    # texts of one id are one node, also where smaller ids name the classes of all of them
    several = members.groupBy("id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b")).where("a <> b").select("id", "a")
    twins = members.join(several, "id").where("class_id <> a").select("a", F.col("class_id").alias("b"))
    return Joined(members, stored(degrees, "degrees", keep=True), links, stored(components(links.unionAll(twins)), "components", keep=True))


def _tile_members(grouped: DataFrame, percent: int) -> DataFrame:
    """Rows (tile, band, side, class) of the tiles that can hold a pair."""
    # sizes within the ratio lie in one band or in neighbours: a row enters the tile of its band and of the one below
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)) + F.lit(1e-9)).cast("long")
    sides = F.greatest(F.ceil(F.count(F.lit(1)) / F.lit(TILE)), F.ceil(F.sum(F.col("n") * 8) / F.lit(TILE_BYTES))).cast("long")
    size = stored(grouped.groupBy("p").agg(sides.alias("k"), F.count(F.lit(1)).alias("c")).where("c > 1"), "sides")
    rows = hot_join(grouped, size, ["p"]).withColumn("band", band).withColumn("side", F.pmod(F.xxhash64(*CLASS), F.col("k")))
    rows = rows.withColumn("lo", F.explode(F.array(F.col("band"), F.col("band") - 1)))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1)))
    rows = rows.select("p", "lo", F.least("side", "other").alias("s1"), F.greatest("side", "other").alias("s2"), "band", "side", *CLASS, "n")
    rows = stored(rows, "tiled")
    full = rows.groupBy(*TILE_KEY).agg(F.count(F.lit(1)).alias("c"), F.min("band").alias("least")).where("c > 1 and least = lo").select(*TILE_KEY, "c")
    return hot_join(rows, stored(full, "tiles"), TILE_KEY)
