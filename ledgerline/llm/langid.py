"""Language identification by mixture inference: expectation-maximisation over n-gram likelihoods.

Model: per language, smoothed log probabilities of hashed byte n-grams (1 to ``ORDER`` bytes) of
lower-cased words with their borders, learned from labelled rows. Inference: each word of a document is a
unit whose likelihood under a language is that of its n-grams; expectation-maximisation estimates the
document's language proportions. Languages whose removal costs less log likelihood than the penalty
(``PENALTY * log(units)``) are removed one by one, smallest first; the language with the largest
proportion of the selected set is the prediction and the proportion is its score.

Everything is in arrays over many documents at a time; only words are decoded, never whole corpora, and no
shuffle is needed to predict. The model is languages x ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import lean, ready

#: Most labelled rows learned from per language, in expectation (a bounded sample chosen by hash of the text).
TRAIN_ROWS = 3_000
BUCKETS, ORDER = 1 << 16, 3
EM_STEPS = 12
PENALTY = 1.0
#: Words longer than this many bytes are taken in parts (texts without spaces).
PART = 24
#: Temper: the n-grams of a word overlap, so their log likelihoods are averaged over the orders.
TEMPER = 1.0 / ORDER


def _parts(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words cut to parts of at most ``PART`` bytes; and the word of each part."""
    count = -(-(ends - starts) // PART)
    of = np.repeat(np.arange(len(starts)), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    s = starts[of] + k * PART
    return s, np.minimum(s + PART, ends[of]), of


def _unit_words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, start and end of each distinct unit, unit of each occurrence, row of each occurrence)."""
    for a, b, raw, off in words.text_slices(column, lower=True):
        starts, ends = words.word_spans(raw, off)
        starts, ends, _ = _parts(starts, ends)
        h = words.span_hashes(raw, starts, ends)
        _, first, unit = np.unique(h, return_index=True, return_inverse=True)
        row = np.searchsorted(off, starts, "right") - 1
        yield a, b, raw, starts[first], ends[first], unit, row


def _grams(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of the units (with a border byte on each side), and the unit of each."""
    size = ends - starts + 2
    base = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint64)
    unit = np.repeat(np.arange(len(starts)), size)
    inside = np.ones(len(flat), bool)
    inside[base] = inside[base + size - 1] = False
    src = np.arange(len(flat)) - np.repeat(base, size) + np.repeat(starts, size) - 1
    flat[inside] = raw[src[inside]].astype(np.uint64) + np.uint64(1)
    last = np.repeat(base + size, size)
    out_b, out_u = [], []
    code = np.zeros(len(flat), np.uint64)
    for n in range(1, ORDER + 1):
        m = len(flat) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(257) + flat[n - 1 :]
        ok = np.arange(m) + n <= last[:m]
        if n == 1:
            ok &= inside[:m]
        h = words.mix(code[ok] + np.uint64(n << 56))
        out_b.append((h & np.uint64(BUCKETS - 1)).astype(np.int64))
        out_u.append(unit[:m][ok])
    if not out_b:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_b), np.concatenate(out_u)


def _count_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """n-gram counts per language of one task's rows."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, group in batch.groupby("lang"):
            counts = total.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for _, _, raw, s, e, unit, _ in _unit_words(pa.array(group["text"], pa.large_string())):
                if len(s):
                    b, u = _grams(raw, s, e)
                    counts += np.bincount(b, weights=np.bincount(unit, minlength=len(s))[u], minlength=BUCKETS).astype(np.int64)
    for lang, counts in total.items():
        at = np.flatnonzero(counts)
        yield pd.DataFrame({"lang": lang, "bucket": at, "c": counts[at]})


class Model:
    """Languages in code-point order and their log probabilities per bucket (buckets x languages)."""

    def __init__(self, langs: list[str], logp: np.ndarray):
        self.langs, self.logp = langs, logp


def train(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> Model:
    """Learns from rows with text and language: a sample of about ``TRAIN_ROWS`` rows per language, chosen by
    hash of the id and so the same in every run. n-grams are counted in the tasks and summed by Spark;
    languages x ``BUCKETS`` counts come to the driver."""
    ready(labelled.sparkSession)
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    sizes = labelled.where(F.col(lang_col).isNotNull()).groupBy(F.col(lang_col).cast("string").alias("lang")).count().collect()
    langs = sorted(r["lang"] for r in sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    part = F.pmod(F.xxhash64("id"), F.lit(1_000_000))
    chosen = F.lit(False)
    for r in sizes:
        chosen = chosen | ((F.col("lang") == r["lang"]) & (part < min(1_000_000, -(-1_000_000 * TRAIN_ROWS // r["count"]))))
    counts = rows.where(chosen).select("lang", "text").mapInPandas(_count_rows, "lang string, bucket long, c long").groupBy("lang", "bucket").agg(F.sum("c").alias("c")).toPandas()
    table = np.full((BUCKETS, len(langs)), 0.5)
    table[counts["bucket"].to_numpy(), counts["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy()] += counts["c"].to_numpy()
    return Model(langs, np.log(table / table.sum(0)).astype(np.float32))


def _mixture(like: np.ndarray, weight: np.ndarray, start: np.ndarray, alive: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """EM over documents: ``like`` (units x languages, scaled per unit), units of a document in a row from
    ``start``, languages in play per document; returns proportions and the log likelihood up to a constant."""
    of = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(like)]))
    total = np.add.reduceat(weight, start)
    pi = share * alive
    pi /= pi.sum(1, keepdims=True)
    for _ in range(EM_STEPS):
        p = like * pi[of]
        p *= (weight / np.maximum(p.sum(1), 1e-30))[:, None]
        pi = np.add.reduceat(p, start, axis=0) / total[:, None]
    seen = np.log(np.maximum(np.einsum("uk,uk->u", like, pi[of]), 1e-30))
    return pi, np.add.reduceat(weight * seen, start)


def _take(start: np.ndarray, n: int, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units of some documents, and where each begins among them."""
    size = np.diff(np.r_[start, n])[docs]
    new = np.cumsum(size) - size
    return np.arange(int(size.sum())) - np.repeat(new, size) + np.repeat(start[docs], size), new


def _select(like: np.ndarray, weight: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Proportions of the selected languages per document: backward elimination by penalised likelihood."""
    n_docs, k = len(start), like.shape[1]
    alive = np.ones((n_docs, k), bool)
    pi, ll = _mixture(like, weight, start, alive, np.full((n_docs, k), 1.0 / k, np.float32))
    cost = PENALTY * np.log(np.maximum(np.add.reduceat(weight, start), 2.0))
    todo = np.arange(n_docs) if k > 1 else np.empty(0, np.int64)
    while len(todo):
        tiny = (pi[todo] < 1e-4) & alive[todo]  # gone already: no fit needed to remove them
        best = pi[todo].argmax(1)
        tiny[np.arange(len(todo)), best] = False
        alive[todo] &= ~tiny
        pi[todo] *= alive[todo]
        pi[todo] /= pi[todo].sum(1, keepdims=True)
        todo = todo[alive[todo].sum(1) > 1]
        if not len(todo):
            break
        least = np.where(alive[todo], pi[todo], 2.0).argmin(1)
        fewer = alive[todo].copy()
        fewer[np.arange(len(todo)), least] = False
        at, new = _take(start, len(like), todo)
        pi2, ll2 = _mixture(like[at], weight[at], new, fewer, np.maximum(pi[todo], 1e-3))
        drop = ll2 + cost[todo] >= ll[todo]
        todo, fewer, pi2, ll2 = todo[drop], fewer[drop], pi2[drop], ll2[drop]
        alive[todo], pi[todo], ll[todo] = fewer, pi2, ll2
    return pi


def _predict_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.langs)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            for a, b, raw, s, e, unit, row in _unit_words(texts):
                share = np.zeros((b - a, max(k, 1)), np.float32)
                if k and len(s):
                    bucket, u = _grams(raw, s, e)
                    word = np.stack([np.bincount(u, weights=model.logp[bucket, j], minlength=len(s)) for j in range(k)], 1) * TEMPER
                    word = np.exp(word - word.max(1, keepdims=True)).astype(np.float32)
                    key, times = np.unique(row.astype(np.int64) * len(s) + unit, return_counts=True)
                    doc = key // len(s)
                    start = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                    share[doc[start]] = _select(word[key % len(s)], times.astype(np.float32), start)
                best = share.argmax(1)
                top = share[np.arange(b - a), best].astype(np.float64)
                ok = letter[a:b] & (top > 0)
                langs = [model.langs[j] if good else "und" for j, good in zip(best.tolist(), ok.tolist())]
                mixed = [{model.langs[j]: float(x) for j, x in enumerate(p) if x > 0} if good else {} for p, good in zip(share[:, :k], ok.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(langs, pa.string()), pa.array(np.clip(np.where(ok, top, 0.0), 0, 1)),
                     pa.array([list(m.items()) for m in mixed], pa.map_(pa.string(), pa.float64()))],
                    ["id", "lang_pred", "score", "mixture"],
                )

    return run


def identify_languages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, mixture map language -> proportion) of every whole text, one row per input row.

    A null text, one without a letter, or any text when nothing was learned, gives ``und``, 0 and an empty
    map. Ties go to the language first in code-point order. Repeated rows give repeated results, null ids
    are kept, other columns are not read; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    ready(spark)
    shared = spark.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(_predict_rows(shared)), f"id {kind}, lang_pred string, score double, mixture map<string, double>")
