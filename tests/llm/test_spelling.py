"""Spelling variants: pairs and forms against all pairs of a small vocabulary, the slip rule, odd texts."""

import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerline.llm.queries import op12_spelling_variants
from ledgerline.llm.spelling import _Letters, _symbols, group_variants, near_words, neighbourhood

SCHEMA = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("id", T.StringType()), T.StructField("word", T.StringType()),
     T.StructField("n", T.LongType()), T.StructField("key", T.StringType()), T.StructField("a.b", T.StringType())]
)
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def make(spark, rows):
    return spark.createDataFrame([(*r, "p", "q", 1, "r", "s") for r in rows], SCHEMA)


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def plain(rows, slip=97, pairs=one_edit):
    counts = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    gaps = {}  # words that share what is left without one letter, or with one
    for w in words:
        for k in range(len(w) + 1):
            gaps.setdefault((w[:k], w[k + 1 :]), set()).add(w) if k < len(w) else None
            gaps.setdefault((w[:k], w[k:]), set()).add(w)
    near = {w: set() for w in words}
    for group in gaps.values():
        for a in group:
            near[a] |= {b for b in group if pairs(a, b)}
    form = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    form = {w: o for w, o in form.items() if words[o] >= 2 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), words[form[w]] if w in form else None, root))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def test_against_all_pairs(spark):
    rng = random.Random(9)
    stems = ["".join(rng.choice("abcdeéß÷") for _ in range(rng.randrange(4, 9))) for _ in range(60)]
    rows = []
    for doc in range(300):
        words = []
        for _ in range(40):
            w = rng.choice(stems[: 1 + rng.randrange(60)])
            if rng.random() < 0.3:
                k = rng.randrange(len(w) + 1)
                w = rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcé") + w[k + 1 :], w[:k] + rng.choice("abcé") + w[k:]])
            words.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((doc if doc % 50 else None, rng.choice([" ", "_", "1", "Ā"]).join(words)))
    rows += [(1, None), (2, ""), (3, "1 2 3")] + [(77, "Hottest " * 5_000)] * 3
    rows += [(500 + k, w) for w, n in (("planet", 100), ("planat", 40), ("plbnat", 15), ("plbnbt", 5)) for k in range(n)]  # a chain of forms
    want = plain(rows)
    assert len(want) > 300 and ("plbnbt", 5, 1, "plbnat", 15, "planet") in want
    df = make(spark, rows)
    assert got(group_variants(df)) == want
    assert got(group_variants(df, symbols=2, bits=15)) == want  # neither choice shows in the result
    assert got(group_variants(df, slip=None)) == plain(rows, slip=None)
    assert group_variants(make(spark, [])).count() == 0


def test_runs_of_one_letter_and_long_words(spark):
    long_ = "ab" * 1_000
    same = ["a" * k for k in range(5, 12)] + ["aabaa", "aabba", "abaaa", "baaaa", "aaaab", "ab" * 32, "ab" * 32 + "a", "ab" * 31 + "a" + "b" * 2]
    words = same + [long_, long_[:-1], "x" + long_, long_[:999] + "z" + long_[1_000:], long_ + "ab"]
    rows = [(None, " ".join(w for w in words for _ in range(3 + 4 * (k % 3)))) for k, w in enumerate(words)]
    assert got(group_variants(make(spark, rows), slip=None)) == plain(rows, slip=None)


@pytest.mark.parametrize("symbols", [2, 4])
def test_the_neighbourhood_is_whole(symbols):
    """Every reduced word one edit away is generated, on the side that keeps its letters."""
    table = _symbols(symbols)
    rng = random.Random(symbols)
    for _ in range(60):
        w = "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(5, 9)))
        x = _Letters([w], table)
        keys = {False: set(), True: set()}
        for _, key, last in neighbourhood(x, symbols):
            keys[last] |= set(key.tolist())
        for k in range(len(w) + 1):
            for other in [w[:k] + w[k + 1 :]] + [w[:k] + c + w[k + j :] for c in "abcdefgh" for j in (0, 1)]:
                if len(other) >= 5:
                    o = _Letters([other], table)
                    last = k < 2
                    assert int(o.key(o.total, o.length, o.last if last else o.first)[0]) in keys[last]


def test_pairs_come_once(spark):
    words = ["aaaaa", "aaaaaa", "aaaab", "baaaa", "abaaa", "aabaa", "aabaaa"]
    df = spark.createDataFrame([(k, w, 1) for k, w in enumerate(words)], "id long, word string, n long")
    pairs = [(r["id"], r["other"]) for r in near_words(df).collect()]
    assert sorted(pairs) == sorted((a, b) for a, v in enumerate(words) for b, w in enumerate(words) if one_edit(v, w))


def test_registered_query_on_the_smallest_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got(op12_spelling_variants(spark, "/root/testdata/sf0.001")) == plain(rows)
