"""Mixing: nothing is left that fits, and the order of the input does not matter."""

import math
import random

from ledgerline.llm import mixing


def _docs():
    rng = random.Random(5)
    rows = [(k, "w " * int(1 + 400 * rng.random() ** 3), "en", rng.choice(["a", "b", "c", "d", None])) for k in range(600)]
    # half of all rows are copies in one source, and one source has a single document of half its words
    return rows + [(1000 + k, "x y z", "en", "b") for k in range(600)] + [(2000, "v " * 3000, "en", "d"), (2001, None, "en", "a"), (2002, "", "en", None)]


def test_no_document_that_fits_is_left(documents):
    got = mixing.mix_sources(documents(_docs())).collect()
    assert len(got) == len(_docs()) and all(0 <= r["copies"] <= 2 and (r["size"] or not r["copies"]) for r in got)
    for source in {r["source"] for r in got}:
        of = [r for r in got if r["source"] == source]
        gap = of[0]["target"] - sum(r["size"] * r["copies"] for r in of)
        able = [r["size"] for r in of if r["size"] and (r["copies"] < 2 if gap > 0 else r["copies"] > 0)]
        assert not able or abs(gap) < max(1, min(able))


def test_the_dual_is_solved(documents):
    """Rates are tilted exponentially with one multiplier a source, and meet the target as sums."""
    got = mixing.mix_sources(documents(_docs())).collect()
    for source in {r["source"] for r in got}:
        of = [r for r in got if r["source"] == source and r["size"]]
        assert abs(sum(r["size"] * r["rate"] for r in of) - of[0]["target"]) <= 1e-6 * of[0]["target"]
        slopes = [math.log(r["rate"]) / r["size"] for r in of if r["rate"] < 2]
        assert not slopes or max(slopes) - min(slopes) <= 1e-9 * max(map(abs, slopes))


def test_runs_agree_whatever_the_order(spark, documents):
    rows = _docs()
    first = mixing.mix_sources(documents(rows).repartition(3)).collect()
    random.Random(1).shuffle(rows)
    second = mixing.mix_sources(documents(rows).repartition(7)).collect()
    assert sorted(map(repr, first)) == sorted(map(repr, second))
