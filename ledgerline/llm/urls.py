"""URL filters: rules first, then logistic regression on hashed character n-grams of host and path.

Host, path and rules are column expressions. The regression learns from a small labelled URL table, bounded by
``TRAIN_URLS`` rows, and scores the other URLs in Arrow batches; its weights are ``BUCKETS`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import lean, ready

TRAIN_URLS = 4_000
BUCKETS, GRAMS = 1 << 15, (3, 4, 5)
STEPS, RATE, DECAY = 150, 0.05, 1e-4


@dataclass(frozen=True)
class Rule:
    """``text`` is host and path, like ``example.org/es/``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path as written; empty for null or without ``://``."""
    parts = "://([^/?#]*)([^?#]*)"
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    take = lambda k: F.coalesce(F.regexp_extract(url, parts, k), F.lit(""))
    return F.translate(take(1), upper, upper.lower()), take(2)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Text of the longest rule that fits, of equal ones the first in code-point order; null if none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(r.text)).otherwise(out)
    return out


def _features(host: pa.Array, path: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams and the row of each; host and path n-grams are told apart."""
    out_b, out_r = [], []
    for kind, column in enumerate((host, path)):
        for a, _, raw, off in words.text_slices(column):
            last = np.repeat(off[1:], np.diff(off))
            row = np.repeat(np.arange(len(off) - 1), np.diff(off)) + a
            code = np.zeros(len(raw), np.uint64)
            for n in range(1, GRAMS[-1] + 1):
                m = len(raw) - n + 1
                if m <= 0:
                    break
                code = code[:m] * np.uint64(257) + raw[n - 1 :].astype(np.uint64) + np.uint64(1)
                if n in GRAMS:
                    ok = np.arange(m) + n <= last[:m]
                    h = words.mix(code[ok] + np.uint64((n * 2 + kind) << 56))
                    out_b.append((h & np.uint64(BUCKETS - 1)).astype(np.int64))
                    out_r.append(row[:m][ok])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *out_b]), np.concatenate([none, *out_r])


class Model:
    """Weights and intercept; ``constant`` is the verdict where there was nothing to tell apart."""

    def __init__(self, weights: np.ndarray, bias: float, constant: bool | None):
        self.weights, self.bias, self.constant = weights, bias, constant

    def allow(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(host), float(self.constant))
        b, r = _features(host, path)
        size = np.maximum(np.bincount(r, minlength=len(host)), 1)
        z = self.bias + np.bincount(r, weights=self.weights[b], minlength=len(host)) / np.sqrt(size)
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(labelled: DataFrame) -> Model:
    """From (host, path, allow boolean): a sample of about ``TRAIN_URLS`` rows by hash of the URL, the same in
    every run. Full-batch logistic regression with Adam and weight decay; without rows of both kinds the
    verdict is constant (allow where there are none)."""
    rows = labelled.where("allow is not null")
    n = rows.count()
    share = F.pmod(F.xxhash64("host", "path"), F.lit(1 << 30)) < int(min(1.0, TRAIN_URLS / max(n, 1)) * (1 << 30))
    sample = rows.where(share).orderBy(F.xxhash64("host", "path"), "host", "path").toPandas()
    y = sample["allow"].to_numpy(float) if len(sample) else np.empty(0)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS), 0.0, bool(y.max()) if len(y) else True)
    host, path = pa.array(sample["host"], pa.string()), pa.array(sample["path"], pa.string())
    b, r = _features(host, path)
    scale = 1 / np.sqrt(np.maximum(np.bincount(r, minlength=len(y)), 1))
    w, bias = np.zeros(BUCKETS), 0.0
    m, v, mb, vb = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    balance = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    for t in range(1, STEPS + 1):
        z = bias + np.bincount(r, weights=w[b], minlength=len(y)) * scale
        g = (1 / (1 + np.exp(-z)) - y) * balance / len(y)
        gw = np.bincount(b, weights=(g * scale)[r], minlength=BUCKETS) + DECAY * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w = w - RATE * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        bias -= RATE * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return Model(w, float(bias), None)


def _judge(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            p = model.allow(batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p, pa.float64())], [*batch.schema.names, "allow_score"])

    return run


def filter_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict, allow_score) of every row.

    A rule fits its host and all subdomains where the path starts with the rule's; the longest wins and gives
    the verdict (allow or block). URLs that no rule fits are judged by the regression, which learns from a
    bounded sample of those that rules decide (score from 0.5 on: allow). Null URLs, and those without
    ``://``, have empty host and path, fit no rule and are judged like any other. Repeated rows and null ids
    are kept; extra columns are not read; an empty table gives an empty table.
    """
    spark = pages.sparkSession
    ready(spark)
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.text, r.verdict)]) if rules else F.lit(None)
    decided = (F.element_at(verdicts, F.col("rule")) if rules else F.lit(None)).cast("string")
    ruled = rows.where("rule is not null").select("host", "path", (decided == "allow").alias("allow"))
    model = train(ruled.distinct())
    kind = rows.schema["id"].dataType.simpleString()
    scored = rows.mapInArrow(lean(_judge(spark.sparkContext.broadcast(model))), f"id {kind}, host string, path string, rule string, allow_score double")
    verdict = F.coalesce(decided, F.when(F.col("allow_score") >= 0.5, "allow").otherwise("block"))
    return scored.select("id", "host", "path", "rule", verdict.alias("verdict"), "allow_score")
