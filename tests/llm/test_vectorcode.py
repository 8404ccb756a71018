"""Vector codes: the tree against every entry, codes and codebooks against a plain loop, odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.llm.vectorcode import Search, compress, cut, gnat, squared

SCHEMA = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())), T.StructField("label", T.IntegerType()),
     T.StructField("id", T.StringType()), T.StructField("x", T.StringType()), T.StructField("code", T.StringType()), T.StructField("a.b", T.StringType())]
)


def make(spark, rows):
    return spark.createDataFrame([(*r, "p", "q", "r", "s") for r in rows], SCHEMA)


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """The contract in a loop over whole numbers."""
    kept = [(i is None, i if i is not None else 0, [max(-(1 << 52), min(1 << 52, math.floor(scale * c))) for c in v], i, lab)
            for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    kept.sort(key=lambda r: r[:3])
    if not kept:
        return [], []
    dim = len(kept[0][2])
    kept = [r for r in kept if len(r[2]) == dim]
    cuts = cut(dim, parts)
    books = [[r[2][lo:hi] for r in kept[:entries]] for lo, hi in cuts]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p, (lo, hi) in enumerate(cuts):
            members = {}
            for r in kept:
                members.setdefault(nearest(r[2][lo:hi], books[p])[1], []).append(r[2][lo:hi])
            books[p] = [[sum(c) // len(c) for c in zip(*members[k])] if k in members else e for k, e in enumerate(books[p])]
    out = []
    for _, _, x, i, lab in kept:
        found = [nearest(x[lo:hi], books[p]) for p, (lo, hi) in enumerate(cuts)]
        out.append((i, "".join(f"{k:02x}" for _, k in found), min(sum(d for d, _ in found), (1 << 63) - 1), lab))
    totals = {}
    for _, _, e, lab in out:
        totals[lab] = totals.get(lab, 0) + e
    return [(i, c, e, min(totals[lab], (1 << 63) - 1)) for i, c, e, lab in out], books


def key(r):
    return (r[0] is None, r[0] or 0, *r[1:])


def check(spark, rows, **how):
    coded = compress(make(spark, rows), **how)
    want, books = plain(rows, **how)
    got = [(r["id"], r["code"], r["error"], r["label_error"]) for r in coded.with_label_errors().collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    flat = ",".join(str(v) for b in books for e in b for v in e)
    assert coded.codebooks_sha256() == hashlib.sha256(flat.encode()).hexdigest()


def test_against_a_plain_loop(spark):
    rng = random.Random(2)
    centres = [[rng.uniform(-1, 1) for _ in range(16)] for _ in range(12)]
    rows = [(i, [c + rng.gauss(0, 0.05) for c in rng.choice(centres)], rng.choice([1, 2, None])) for i in range(500)]
    rows += [(700 + k, rows[3][1], 5) for k in range(300)]  # a large group of copies
    check(spark, rows)
    check(spark, rows[:40], entries=7, rounds=2, parts=3)


def test_odd_rows(spark):
    odd = [(1, None, 1), (2, [0.5, None, 0.5, 0.5], 1), (3, [math.nan] * 4, 1), (4, [math.inf] * 4, 1), (5, [0.0] * 4, None), (5, [0.0] * 4, 2), (5, [-0.001, 0.0, 0.25, 1.0], 2),
           (None, [0.1] * 4, 2), (None, [0.1] * 4, 2), (6, [0.1] * 8, 3), (7, [], 3), (8, [1e300, -1e300, 3e9, 1.0], 7), (9, [1e300, -1e300, 3e9, 1.0], 7), (10, [-1e300, 1e300, 0.0, 0.0], 8)]
    check(spark, odd)
    check(spark, odd, entries=1)
    check(spark, [(7, [], 3), (8, [], None)])
    check(spark, [(7, [0.5, 0.25], 3), (8, [0.125, 0.5], None)])  # fewer components than parts
    empty = compress(make(spark, []))
    assert empty.with_label_errors().count() == 0 and empty.codebooks_sha256() == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("spread", [3, 1_000, 1 << 40])
def test_the_tree_finds_the_nearest_entry_and_the_lowest_of_equals(spread):
    rng = np.random.default_rng(4)
    centres = rng.integers(-spread, spread + 1, (20, 6))
    entries = centres[rng.integers(0, 20, 256)] + rng.integers(-2, 3, (256, 6)) * max(1, spread // 100)
    queries = np.concatenate([entries[:80], centres[rng.integers(0, 20, 300)] + rng.integers(-3, 4, (300, 6)) * max(1, spread // 100)])
    found = Search(gnat(entries), entries, queries)
    d2 = [[sum((int(a) - int(b)) ** 2 for a, b in zip(q, e)) for e in entries] for q in queries]
    assert [int(b) for b in found.best] == [min(row) for row in d2]
    assert found.index.tolist() == [row.index(min(row)) for row in d2]
    if spread == 1_000:  # clustered entries: most of them are never looked at
        assert found.distances < 0.6 * len(queries) * len(entries)


def test_equal_entries_and_large_components():
    entries = np.array([[5, 5]] * 300 + [[1 << 52, -(1 << 52)]], np.int64)
    found = Search(gnat(entries), entries, np.array([[5, 5], [6, 5], [1 << 52, -5]], np.int64))
    assert found.index.tolist() == [0, 0, 300] and [int(b) for b in found.best] == [0, 1, ((1 << 52) - 5) ** 2]
    assert int(squared(np.array([[1 << 52]]), np.array([[-(1 << 52)]]))[0, 0]) == 1 << 106
