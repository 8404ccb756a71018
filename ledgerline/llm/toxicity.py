"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as the embedding of its hash beside the mean embedding of its character n-grams (over its bytes in
lower case, with borders); a word of more than ``PART`` bytes enters as several, so texts without spaces are read
to their end. Gated recurrent units read a window of ``WINDOW`` words in both directions; attention
weighs the states, and a linear layer turns the pooled state into the window's logit. Every text is cut into all
windows ``STRIDE`` words apart, so they overlap by half and every word is read; a document's score is that of
its highest window, shifted so that one half is the best cut on the training documents.

Labels belong to documents, not windows: after a first pass in which every sampled window has its document's
label, a toxic document teaches with its currently highest window, a clean one with its ``HARD_WINDOWS`` highest.

Training is on the driver, over a bounded sample (``TRAIN_DOCS`` documents of each label, at most
``DOC_WINDOWS`` windows of each); scoring runs in Arrow batches over whole texts. The parameters are a few MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words
from .common import lean, ready

#: Most labelled documents learned from per label, in expectation, chosen by hash of the id.
TRAIN_DOCS, DOC_WINDOWS, HARD_WINDOWS = 1_200, 6, 4
WINDOW, STRIDE = 32, 16
#: Words longer than this many bytes are taken in parts, each in a place of its own (texts without spaces).
PART = 40
WORDS, CHARS, EMBED, HIDDEN = 1 << 14, 1 << 12, 8, 8
EPOCHS, BATCH, RATE = 5, 128, 0.01
#: Windows that are scored together.
CHUNK = 2_048


def _words(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, long ones cut to parts, and the first of each text (length texts + 1)."""
    starts, ends = words.word_spans(raw, off)
    count = -(-(ends - starts) // PART)
    of = np.repeat(np.arange(len(starts)), count)
    k = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    cut = starts[of] + k * PART
    return cut, np.minimum(cut + PART, ends[of]), np.searchsorted(cut, off)


def _word_inputs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket per word; character n-gram buckets (2 to 4 bytes) of all words, and where each word's begin."""
    size = ends - starts + 2
    base = np.cumsum(size) - size
    flat = np.zeros(int(size.sum()), np.uint64)
    src = np.arange(len(flat)) - np.repeat(base, size) + np.repeat(starts, size) - 1
    inside = np.ones(len(flat), bool)
    inside[base] = inside[base + size - 1] = False
    flat[inside] = raw[src[inside]].astype(np.uint64) + np.uint64(1)
    word = np.repeat(np.arange(len(starts)), size)
    last = np.repeat(base + size, size)
    code, buckets, of = flat, [], []
    for n in (2, 3, 4):
        m = len(flat) - n + 1
        if m <= 0:
            break
        code = code[:m] * np.uint64(257) + flat[n - 1 :]
        ok = np.arange(m) + n <= last[:m]
        buckets.append((words.mix(code[ok] + np.uint64(n << 56)) & np.uint64(CHARS - 1)).astype(np.int64))
        of.append(word[:m][ok])
    b, o = np.concatenate(buckets), np.concatenate(of)
    order = np.argsort(o, kind="stable")
    return (hashes & np.uint64(WORDS - 1)).astype(np.int64), b[order], np.searchsorted(o[order], np.arange(len(starts)))


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word index of every window's start, and its text; ``first``: first word of each text (length texts + 1)."""
    n = np.diff(first)
    count = np.where(n > 0, np.maximum(1, -(-(n - (WINDOW - STRIDE)) // STRIDE)), 0)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    return first[text] + k * STRIDE, text


def _slices(column: pa.Array) -> Iterator[tuple]:
    """(first row, end row, inputs of the distinct words, word of each place, window starts, window texts, first words)."""
    for a, b, raw, off in words.text_slices(column, lower=True):
        starts, ends, first = _words(raw, off)
        if len(starts):
            h = words.span_hashes(raw, starts, ends)
            distinct, one, unit = np.unique(h, return_index=True, return_inverse=True)
            inputs = _word_inputs(raw, starts[one], ends[one], distinct)
        else:
            inputs, unit = None, np.empty(0, np.int64)
        at, text = _windows(first)
        yield a, b, inputs, unit, at, text, first


def _places(unit: np.ndarray, at: np.ndarray, text: np.ndarray, first: np.ndarray, pad: int) -> np.ndarray:
    """Word numbers of the windows (windows x WINDOW); ``pad`` behind the end of a text."""
    place = at[:, None] + np.arange(WINDOW)
    out = place >= first[text + 1][:, None]
    return np.where(out, pad, unit[np.minimum(place, len(unit) - 1)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters and passes. Gates lie side by side: update, reset, candidate."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = np.float32
        self.p = {
            "word": r.normal(0, 0.1, (WORDS, EMBED)).astype(f), "char": r.normal(0, 0.1, (CHARS, EMBED)).astype(f),
            "att": r.normal(0, 0.1, 2 * HIDDEN).astype(f), "out": r.normal(0, 0.3, 2 * HIDDEN).astype(f), "bias": np.zeros(1, f),
        }
        for d in "fb":
            self.p["w" + d] = r.normal(0, 0.3, (2 * EMBED, 3 * HIDDEN)).astype(f)
            self.p["u" + d] = r.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)).astype(f)
            self.p["c" + d] = np.zeros(3 * HIDDEN, f)
        self.shift = 0.0

    def embed(self, inputs) -> np.ndarray:
        """Input vector of each distinct word."""
        bucket, grams, begin = inputs
        size = np.diff(np.r_[begin, len(grams)])
        chars = np.add.reduceat(self.p["char"][grams], begin, axis=0) / size[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][bucket], chars], 1)

    def gates(self, x: np.ndarray, d: str) -> np.ndarray:
        """What each word adds to the gates; the last row is for padding: its update gate keeps the state."""
        g = np.zeros((len(x) + 1, 3 * HIDDEN), np.float32)
        g[:-1] = x @ self.p["w" + d] + self.p["c" + d]
        g[-1, :HIDDEN] = 80
        return g

    def read(self, gates: np.ndarray, ids: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States after every word (WINDOW x windows x HIDDEN), in the order of the words."""
        u = self.p["u" + d]
        h = np.zeros((len(ids), HIDDEN), np.float32)
        out = np.empty((WINDOW, len(ids), HIDDEN), np.float32)
        for t in range(WINDOW) if d == "f" else range(WINDOW - 1, -1, -1):
            g = gates[ids[:, t]]
            m = h @ u
            zr = g[:, : 2 * HIDDEN] + m[:, : 2 * HIDDEN]
            np.clip(zr, -60, 60, out=zr)
            zr = _sigmoid(zr)
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            n = np.tanh(g[:, 2 * HIDDEN :] + r * m[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, n, m[:, 2 * HIDDEN :]))
            h = n + z * (h - n)
            out[t] = h
        return out

    def pool(self, states: np.ndarray, pad: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        e = states @ self.p["att"]
        e[pad] = -1e9
        e = np.exp(e - e.max(0))
        a = e / e.sum(0)
        return a, np.einsum("tb,tbh->bh", a, states)

    def logits(self, inputs, unit: np.ndarray, at: np.ndarray, text: np.ndarray, first: np.ndarray) -> np.ndarray:
        x = self.embed(inputs)
        gf, gb = self.gates(x, "f"), self.gates(x, "b")
        out = np.empty(len(at), np.float32)
        for k in range(0, len(at), CHUNK):
            ids = _places(unit, at[k : k + CHUNK], text[k : k + CHUNK], first, len(x))
            states = np.concatenate([self.read(gf, ids, "f"), self.read(gb, ids, "b")], 2)
            _, pooled = self.pool(states, (ids == len(x)).T)
            out[k : k + CHUNK] = pooled @ self.p["out"] + self.p["bias"][0]
        return out

    def gradients(self, inputs, ids: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean weighted cross entropy of windows ``ids`` (numbers of the words in ``inputs``), and its gradients."""
        p = self.p
        bucket, grams, begin = inputs
        x = self.embed(inputs)
        pad = (ids == len(x)).T
        trace: dict[str, list] = {"f": [], "b": []}
        table = {d: self.gates(x, d) for d in "fb"}
        states = np.concatenate([self.read(table[d], ids, d, trace[d]) for d in "fb"], 2)
        a, pooled = self.pool(states, pad)
        logit = pooled @ p["out"] + p["bias"][0]
        prob = _sigmoid(logit)
        loss = float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())
        g: dict[str, np.ndarray] = {}
        dl = (weight * (prob - y) / weight.sum()).astype(np.float32)
        g["out"], g["bias"] = pooled.T @ dl, np.array([dl.sum()], np.float32)
        dpool = dl[:, None] * p["out"]
        da = np.einsum("bh,tbh->tb", dpool, states)
        de = a * (da - (a * da).sum(0))
        g["att"] = np.einsum("tb,tbh->h", de, states)
        dstates = a[:, :, None] * dpool + de[:, :, None] * p["att"]
        dx = np.zeros_like(x)
        for d, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, 2 * HIDDEN))):
            u = p["u" + d]
            du, dg = np.zeros_like(u), np.zeros_like(table[d])
            dh = np.zeros((len(ids), HIDDEN), np.float32)
            for t, h, z, r, n, mc in reversed(trace[d]):
                dh = dh + dstates[t][:, part]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * mc * r * (1 - r)
                dm = np.concatenate([dz, dr, dn * r], 1)
                np.add.at(dg, ids[:, t], np.concatenate([dz, dr, dn], 1))
                du += h.T @ dm
                dh = dh * z + dm @ u.T
            g["u" + d], dg = du, dg[:-1]
            g["w" + d], g["c" + d] = x.T @ dg, dg.sum(0)
            dx += dg @ p["w" + d].T
        size = np.diff(np.r_[begin, len(grams)])
        g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
        np.add.at(g["word"], bucket, dx[:, :EMBED])
        np.add.at(g["char"], grams, np.repeat(dx[:, EMBED:] / size[:, None].astype(np.float32), size, axis=0))
        return loss, g


def _subset(inputs, ids: np.ndarray, pad: int):
    """The inputs of the words in ``ids`` only, and the ids renumbered."""
    bucket, grams, begin = inputs
    used, new = np.unique(ids, return_inverse=True)
    new = new.reshape(ids.shape)
    real = used[used != pad]
    ends = np.r_[begin[1:], len(grams)]
    size = ends[real] - begin[real]
    start = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(start, size) + np.repeat(begin[real], size)
    # padding has the highest number, so it stays the last one, len(real), where it occurs
    return (bucket[real], grams[at], start), new


def fit(texts: list[str], toxic: np.ndarray, seed: int = 7) -> Network:
    """Trains on whole documents with labels; the same input gives the same network."""
    net = Network(seed)
    rng = np.random.default_rng(seed)
    keep = [i for i, t in enumerate(texts) if t.strip(" \t\n\v\f\r")]
    texts, y = [texts[i] for i in keep], np.asarray(toxic)[keep].astype(np.float32)
    if not len(y) or y.min() == y.max():
        net.p["bias"][0] = 0.0 if not len(y) else (3.0 if y.max() > 0 else -3.0)
        net.p["out"][:] = 0
        return net
    raw = np.frombuffer("\n".join(texts).lower().encode(), np.uint8)
    lengths = [len(t.lower().encode()) + 1 for t in texts]
    off = np.minimum(np.r_[0, np.cumsum(lengths)], len(raw))
    starts, ends, first = _words(raw, off)
    h = words.span_hashes(raw, starts, ends)
    distinct, one, unit = np.unique(h, return_index=True, return_inverse=True)
    inputs = _word_inputs(raw, starts[one], ends[one], distinct)
    pad = len(distinct)
    at, text = _windows(first)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v2 = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(EPOCHS):
        # the first time windows at random, later the highest: one of a toxic document, several of a clean one
        rank = net.logits(inputs, unit, at, text, first) if epoch else rng.random(len(at))
        by = np.lexsort((-rank, text))
        begin = np.searchsorted(text[by], np.arange(len(texts)))
        place = np.arange(len(by)) - begin[text[by]]
        use = by[place < (np.where(y[text[by]] > 0, 1, HARD_WINDOWS) if epoch else DOC_WINDOWS)]
        label = y[text[use]]
        # both labels weigh the same
        share = label.mean()
        weight = np.where(label > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        order = rng.permutation(len(use))
        for k in range(0, len(use), BATCH):
            rows = order[k : k + BATCH]
            ids = _places(unit, at[use[rows]], text[use[rows]], first, pad)
            part, ids = _subset(inputs, ids, pad)
            _, g = net.gradients(part, ids, label[rows], weight[rows])
            step += 1
            for name, grad in g.items():
                m[name] += 0.1 * (grad - m[name])
                v2[name] += 0.01 * (grad * grad - v2[name])
                net.p[name] -= RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(v2[name] / (1 - 0.99**step)) + 1e-6)
    # the cut between toxic and clean documents: halfway among the best ones
    best = np.full(len(texts), -np.inf, np.float32)
    np.maximum.at(best, text, net.logits(inputs, unit, at, text, first))
    cuts = np.sort(best)
    mids = (cuts[1:] + cuts[:-1]) / 2
    hits = np.searchsorted(np.sort(best[y > 0]), mids)
    right = (y > 0).sum() - hits + np.searchsorted(np.sort(best[y == 0]), mids)
    good = np.flatnonzero(right == right.max())
    net.shift = float(np.median(mids[good]))
    return net


def learn(labelled: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic") -> Network:
    """Collects the bounded sample of labelled documents and trains. Null texts and labels are left out."""
    rows = labelled.where(F.col(text_col).isNotNull() & F.col(label_col).isNotNull())
    sizes = {r[label_col]: r["count"] for r in labelled.where(F.col(label_col).isNotNull()).groupBy(label_col).count().collect()}
    chosen = F.lit(False)
    for value, n in sizes.items():
        share = int(min(1.0, TRAIN_DOCS / n) * (1 << 30))
        chosen = chosen | ((F.col(label_col) == value) & (F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) < share))
    sample = rows.where(chosen).select(id_col, F.col(text_col).alias("t"), F.col(label_col).alias("y")).toPandas()
    sample = sample.sort_values([id_col, "t"], kind="stable")
    return fit(sample["t"].tolist(), sample["y"].to_numpy(float))


def _score_rows(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        empty = float(net.p["bias"][0]) - net.shift
        for batch in batches:
            for a, b, inputs, unit, at, text, first in _slices(batch.column(1)):
                best = np.full(b - a, -np.inf, np.float32)
                if len(at):
                    np.maximum.at(best, text, net.logits(inputs, unit, at, text, first))
                z = np.where(np.isfinite(best), best.astype(np.float64) - net.shift, min(empty, -1.0))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(_sigmoid(np.clip(z, -50, 50)))], ["id", "score"])

    return run


def score_texts(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every whole text, one row per input row: 0 to 1, higher: toxic likelier.

    Null, empty and blank texts have no window and get a low score below one half. Repeated rows give
    repeated results, null ids are kept, other columns are not read; an empty table gives an empty table.
    """
    ready(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(lean(_score_rows(docs.sparkSession.sparkContext.broadcast(net))), f"id {kind}, score double")
