"""Spelling variant grouping: one-edit pairs of words found through a reduced alphabet.

Letters are hashed to a few symbols. Of every reduced word the full one-edit neighbourhood is generated (all deletions,
replacements and insertions over the few symbols, a fraction of what the real alphabet needs) and joined with the
reduced vocabulary; what meets is verified on the original words. Two letters join unreduced: an edit leaves either the
first two or the last two letters as they are, so a neighbour also carries those, which keeps the groups that meet
small. Reduced words are 64-bit hashes that an edit changes in constant time, so a word of any length is generated
in time and space that grow with its length alone.

A bitmap of fixed size over the vocabulary's keys (built by Spark, 8 MB whatever the vocabulary) goes to the tasks
that generate neighbours and drops most of those that meet nothing; the join decides.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, ready, stored
from .words import mix

RUN = re.compile("[a-zÀ-ÿ]+")
#: Symbols of the reduced alphabet.
SYMBOLS = 4
#: Letters that join unreduced.
EXACT = 2
#: Bits of the bitmap, as a power of two.
BITS = 26
#: Words that a counting task holds at a time, and letters that a generating task works on at a time.
HELD = 200_000
LETTERS = 1 << 17
#: Longer words join by number and are verified in a join of their own, not carried along with every neighbour.
INLINE = 64
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def _count(min_chars: int, slip: int | None):
    """Counts per task: words of whole texts, runs that the slip rule picks without one of their letters."""

    def batch_of(counts: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                begin = zlib.crc32(f"{doc or ''}:".encode())
                # bytes.lower folds A-Z alone
                for word, k in Counter(RUN.findall(text.encode().lower().decode())).items():
                    if len(word) < min_chars:
                        continue
                    if slip:
                        h = zlib.crc32(word.encode(), begin)
                        if h % slip == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < min_chars:
                                continue
                    counts[word] = counts.get(word, 0) + k
                if len(counts) >= HELD:
                    yield batch_of(counts)
                    counts = {}
        if counts:
            yield batch_of(counts)

    return run


def vocabulary(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_count: int, slip: int | None) -> DataFrame:
    """(id, word, n); ids ascend in code-point order of the words."""
    rows = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).cast("string").alias("text")).where("text is not null")
    counted = rows.mapInArrow(lean(_count(min_chars, slip)), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)
    counted = stored(counted, "counts")  # ranges are sampled: the rows must not be made twice
    # a prefix bounds what the sample of the ranges holds; whole words order the rows
    return stored(counted.repartitionByRange(F.substring("word", 1, INLINE)).sortWithinPartitions("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "vocabulary")


def _symbols(symbols: int) -> np.ndarray:
    """The symbol (from 1) of each letter."""
    return (mix(np.arange(256, dtype=np.uint64) + _U(1)) % _U(symbols) + _U(1)).astype(np.uint64)


class _Letters:
    """Some words as flat arrays: per letter its word, place, symbol and the hash of the letters before it."""

    def __init__(self, words: list[str], symbols: np.ndarray):
        raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
        self.length = np.array([len(w) for w in words], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])
        self.word = np.repeat(np.arange(len(words)), self.length)
        self.place = np.arange(len(raw)) - self.start[self.word]
        longest = int(self.length.max(initial=0)) + 2
        with np.errstate(over="ignore"):
            power = np.concatenate([[_U(1)], np.cumprod(np.full(longest, _U(_BASE)))])
            self.symbol = symbols[raw]
            sums = np.concatenate([[_U(0)], np.cumsum(self.symbol * power[self.place], dtype=np.uint64)])
            self.power = power
            self.before = sums[:-1] - sums[self.start[self.word]]
            self.total = sums[self.start[1:]] - sums[self.start[:-1]]
        code = raw.astype(np.uint64) + _U(1)
        first, last = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
        for k in range(EXACT):
            first = first * _U(257) + code[self.start[:-1] + k]
            last = last * _U(257) + code[self.start[1:] - EXACT + k]
        # the unreduced letters of either side, told apart
        self.first, self.last = mix(first), mix(last + _U(1 << 40))

    def key(self, reduced: np.ndarray, length: np.ndarray, exact: np.ndarray) -> np.ndarray:
        return mix(reduced + length.astype(np.uint64) * _U(0xD6E8FEB86659FD93) + exact)


def _slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    words, at, held, begin = batch.column(column).to_pylist(), 0, 0, 0
    for at, w in enumerate(words):
        if held and held + len(w) > LETTERS:
            yield begin, words[begin:at]
            begin, held = at, 0
        held += len(w)
    if words:
        yield begin, words[begin:]


def _own_keys(symbols: int):
    """Every word under its two keys: reduced, with its first or its last letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _symbols(symbols)
        for batch in batches:
            for begin, words in _slices(batch, "word"):
                x = _Letters(words, table)
                piece = batch.slice(begin, len(words))
                inline = pa.array([w if len(w) <= INLINE else None for w in words], pa.string())
                for exact in (x.first, x.last):
                    key = pa.array(x.key(x.total, x.length, exact).view(np.int64), pa.int64())
                    yield pa.RecordBatch.from_arrays([key, piece.column("id"), inline, piece.column("n")], names=["key", "id", "word", "n"])

    return run


def neighbourhood(x: _Letters, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(word, key, last) of all one-edit neighbours of the reduced words, themselves included; ``last``: the letters
    that join unreduced are the last ones (the edit is among the first)."""
    w, i, power = x.word, x.place, x.power
    every = np.arange(len(x.length))
    total, length = x.total[w], x.length[w]
    for last, side, at in ((False, x.first, i >= EXACT), (True, x.last, i < EXACT)):
        yield every, x.key(x.total, x.length, side), last
        wa, ia, before, symbol, all_, n, exact = w[at], i[at], x.before[at], x.symbol[at], total[at], length[at], side[w[at]]
        with np.errstate(over="ignore"):
            here = symbol * power[ia]
            yield wa, x.key(before + (all_ - before - here) * _U(_BACK), n - 1, exact), last
            for c in range(1, symbols + 1):
                other = symbol != _U(c)
                yield wa[other], x.key((all_ - here + _U(c) * power[ia])[other], n[other], exact[other]), last
                yield wa, x.key(before + _U(c) * power[ia] + (all_ - before) * _U(_BASE), n + 1, exact), last
                if not last:  # behind the last letter
                    yield every, x.key(x.total + _U(c) * power[x.length], x.length + 1, side), last


def _neighbours(symbols: int, bits: int, shared):
    """The neighbours whose keys the bitmap holds, each key of a word once a side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, table = shared.value, _symbols(symbols)
        for batch in batches:
            for begin, words in _slices(batch, "word"):
                x = _Letters(words, table)
                found: dict[bool, list] = {False: [], True: []}
                for word, key, last in neighbourhood(x, symbols):
                    bit = (key >> _U(64 - bits)).astype(np.int64)
                    hit = (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0
                    found[last].append((word[hit], key[hit]))
                for last, parts in found.items():
                    word, key = (np.concatenate(c) for c in zip(*parts))
                    order = np.lexsort((key, word))
                    word, key = word[order], key[order]
                    new = np.ones(len(word), bool)
                    new[1:] = (word[1:] != word[:-1]) | (key[1:] != key[:-1])
                    word, key = word[new], key[new]
                    inline = pa.array([w if len(w) <= INLINE else None for w in words], pa.string())
                    ids = batch.column("id").slice(begin, len(words))
                    at = pa.array(word)
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64), pa.int64()), ids.take(at), inline.take(at), pa.array(np.full(len(word), last))], names=["key", "id", "word", "last"])

    return run


def bitmap_of(keys: DataFrame, bits: int) -> np.ndarray:
    """Which of 2^bits prefixes the keys have: made by Spark, 2^bits / 8 bytes on the driver at any size."""
    bit = F.shiftrightunsigned("key", 64 - bits) + 1
    built = keys.select(F.bitmap_bucket_number(bit).alias("bucket"), F.bitmap_bit_position(bit).alias("bit")).groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in built.toLocalIterator():
        part = np.frombuffer(r["bits"], np.uint8)
        out[(r["bucket"] - 1) * len(part) :][: len(part)] = part[: len(out)]
    return out


def near_words(words: DataFrame, symbols: int = SYMBOLS, bits: int = BITS) -> DataFrame:
    """(id, other, n): every ordered pair of words (id, word, n) that differ by exactly one inserted, deleted or
    replaced code point, once; n is the other's. Words have ``EXACT`` + 3 letters or more, of RUN."""
    spark = words.sparkSession
    keys = stored(words.mapInArrow(lean(_own_keys(symbols)), "key long, id long, word string, n long"), "keys")
    shared = spark.sparkContext.broadcast(bitmap_of(keys, bits))
    made = words.select("id", "word").mapInArrow(lean(_neighbours(symbols, bits, shared)), "key long, id long, word string, last boolean")
    right = keys.select("key", F.col("id").alias("other"), F.col("word").alias("other_word"), "n")
    met = made.join(right, "key").where("id <> other")
    # a pair is met on both sides if the edit can stand on either: those with equal first letters count as first
    fresh = ~F.col("last") | (F.substring("word", 1, EXACT) != F.substring("other_word", 1, EXACT))
    short = F.col("word").isNotNull() & F.col("other_word").isNotNull()
    met = met.where(~short | (fresh & (F.levenshtein("word", "other_word", 1) == 1)))
    met = stored(met.select("id", "other", "n", short.alias("short")), "met")
    # the few pairs of long words: each once, with their words
    long_ = met.where("not short").select("id", "other", "n").distinct()
    a, b = words.select("id", F.col("word").alias("_a")), words.select(F.col("id").alias("other"), F.col("word").alias("_b"))
    long_ = long_.join(a, "id").join(b, "other").where(F.levenshtein("_a", "_b", 1) == 1).select("id", "other", "n")
    return met.where("short").select("id", "other", "n").unionAll(long_)


def group_variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 5, min_count: int = 3, factor: int = 2, slip: int | None = 97, symbols: int = SYMBOLS, bits: int = BITS,
) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for every word of at least ``min_chars`` code points that occurs at least
    ``min_count`` times in all texts: how many words are one edit away, the most frequent of them (ties: the
    smallest in code-point order) if it is at least ``factor`` times as frequent, and where following forms ends.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, with A-Z lower-cased. ``slip``: a run whose
    crc32 of ``<id>:<run>`` this divides loses one letter (a null id is empty text); None leaves runs alone. Null
    and empty texts have no words; texts and words may be of any length; repeated rows count again; extra columns are
    not read; an empty table gives no rows.
    """
    if min_chars < EXACT + 3 or factor < 2:
        raise ValueError("words of five code points or more, and forms at least twice as frequent")
    ready(docs.sparkSession)
    words = vocabulary(docs, id_col, text_col, min_chars, min_count, slip)
    # smaller ids are smaller words; a hot word's rows are reduced in the tasks that find them
    best = near_words(words, symbols, bits).groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("m"), "other")).alias("best"))
    best = best.select("id", "n_near", F.col("best.other").alias("other"), (-F.col("best.m")).alias("other_n"))
    ranked = words.join(best, "id", "left").withColumn("up", F.when(F.col("other_n") >= factor * F.col("n"), F.col("other")))
    ranked = stored(ranked.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "up", F.when(F.col("up").isNotNull(), F.col("other_n")).alias("form_n")), "forms")

    # roots by pointer doubling: a form is at least twice as frequent, so chains and rounds are few
    hops = ranked.where("up is not null").select("id", F.col("up").alias("root"))
    while True:
        on = hops.select(F.col("id").alias("root"), F.col("root").alias("next"))
        jumped = stored(hops.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        hops = jumped.select("id", "root")
        if jumped.where("moved").isEmpty():
            break
    named = words.select(F.col("id").alias("_i"), F.col("word").alias("_w"))
    out = ranked.join(hops, "id", "left")
    out = out.join(named.withColumnsRenamed({"_i": "up", "_w": "form"}), "up", "left")
    out = out.join(named.withColumnsRenamed({"_i": "root", "_w": "root_word"}), "root", "left")
    return out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root_word", "word").alias("root"))
