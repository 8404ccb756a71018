"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns give the spans of three kinds; a fourth pattern gives other long mixed tokens as candidates. The
hashes of all candidate values are aggregated over the corpus by distinct repositories and owners, exact copies that
one owner holds being one repository: a value is owner-specific, and live-looking, if one owner has ``LIVE_SHARE`` of its
repositories or more (a single owner has all of them, in however many), and a widely copied example otherwise.
Live-looking candidates are added as spans of kind ``token``; base spans always stay, and are counted as live or example too.

A span's place comes from the text between the matches: the pieces that the pattern splits the text into, and
the matches, in turn. Running sums and maxima go block by block (:func:`_running`), so a text of many spans costs
little more than their number. Values are only kept as hashes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hot_join, stored

#: Fixed patterns of the base kinds: (kind, pattern, group whose length counts, least length). A run of hex digits or
#: of key characters is taken whole, so its least length may stand in the pattern; an assignment's may not, as a
#: match that is too short still uses up its text.
BASE = [
    ("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", "(AKIA[A-Z0-9]{16,})", 1, 20),
    ("hex", "([0-9a-f]{24,})", 1, 24),
]
#: Other candidates: long tokens of key characters, with digits and letters of both cases.
TOKEN = ("token", "([A-Za-z0-9+/_-]{20,})", 1, 20)
KINDS = [k for k, *_ in BASE] + [TOKEN[0]]
#: A value is owner-specific if one owner has this share of its repositories.
LIVE_SHARE = 0.9
#: Numbers of one block of a running sum.
BLOCK = 128
SPANS = "array<struct<start:int,kind:int,end:int,h:bigint>>"


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9].*[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")


def _found(text: Column, order: int, pattern: str, group: int, least: int) -> Column:
    """Array of (start, kind, end, hash of the value) of the matches, as code points."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)
    lengths = F.zip_with(F.transform(between, F.length), F.transform(matches, F.length), lambda p, m: F.struct(p.alias("p"), F.coalesce(m, F.lit(0)).alias("m")))
    # a piece begins where the match before it ends, a match where its piece ends
    ends = _running(F.transform(lengths, lambda x: x["p"] + x["m"]), lambda u, v: u + v)
    begun = F.zip_with(ends, lengths, lambda e, x: e - x["m"])
    spans = F.arrays_zip(begun.alias("start"), matches.alias("match"), values.alias("value"))
    kept = F.filter(spans, lambda s: s["match"].isNotNull() & (F.length(s["value"]) >= least) & (_mixed(s["value"]) if KINDS[order] == TOKEN[0] else F.lit(True)))
    out = F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("kind"), (s["start"] + F.length(s["match"])).alias("end"), F.xxhash64(s["value"]).alias("h")))
    return F.when(text.rlike(pattern), out).otherwise(F.array().cast(SPANS))


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """``values`` (ints) each combined with all before it. A fold copies what it has so far at every step, so it
    runs within blocks, then over the blocks' last values: n * BLOCK / 2 + (n / BLOCK)^2 / 2 copied numbers."""

    def fold(xs: Column) -> Column:
        grown = lambda s, x: F.array_append(s, F.coalesce(op(F.element_at(s, -1), x), x))
        first = F.slice(xs, 1, 1)
        return F.aggregate(F.slice(xs, 2, F.greatest(F.size(xs) - 1, F.lit(0))), first, grown)

    def joined(blocks: Column) -> Column:
        before = fold(F.transform(F.slice(blocks, 1, F.size(blocks) - 1), lambda b: F.element_at(b, -1)))
        return F.flatten(F.zip_with(blocks, F.concat(F.array(F.lit(None).cast("int")), before), lambda b, e: F.transform(b, lambda x: F.coalesce(op(e, x), x))))

    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(BLOCK))
    within = F.transform(F.array(values), lambda v: F.transform(starts, lambda i: fold(F.slice(v, i, BLOCK))))
    return F.when(F.size(values) == 0, values).otherwise(F.element_at(F.transform(within, joined), 1))


def _apart(rows: DataFrame) -> DataFrame:
    """``other`` without the spans that overlap one of ``base``: in order of their starts, a span is apart if all base
    spans that start no later end before it, and the next one starts after it."""
    event = lambda name, flag: F.transform(name, lambda s: F.struct(s["start"].alias("start"), F.lit(flag).alias("other"), s["end"].alias("end"), s["kind"].alias("kind"), s["h"].alias("h")))
    either = (F.size("base") > 0) & (F.size("other") > 0)
    none = F.array().cast("array<struct<start:int,other:int,end:int,kind:int,h:bigint>>")
    swept = rows.withColumn("_ev", F.when(either, F.array_sort(F.concat(event("base", 0), event("other", 1)))).otherwise(none))
    far = F.lit(2**31 - 1)
    swept = swept.withColumn("_behind", F.transform("_ev", lambda e: F.when(e["other"] == 0, e["end"]).otherwise(0)))
    swept = swept.withColumn("_ahead", F.reverse(F.transform("_ev", lambda e: F.when(e["other"] == 0, e["start"]).otherwise(far))))
    swept = swept.withColumn("_behind", _running(F.col("_behind"), F.greatest)).withColumn("_ahead", F.reverse(_running(F.col("_ahead"), F.least)))
    kept = F.filter(F.arrays_zip(F.col("_ev").alias("e"), F.col("_behind").alias("behind"), F.col("_ahead").alias("ahead")), lambda z: (z["e"]["other"] == 1) & (z["behind"] <= z["e"]["start"]) & (z["ahead"] >= z["e"]["end"]))
    kept = F.transform(kept, lambda z: F.struct(z["e"]["start"].alias("start"), z["e"]["kind"].alias("kind"), z["e"]["end"].alias("end"), z["e"]["h"].alias("h")))
    return swept.withColumn("other", F.when(either, kept).otherwise(F.col("other"))).drop("_ev", "_behind", "_ahead")


def _text_of(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan_secrets(docs: DataFrame, repo_col: str = "doc_id", owner_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, base, spans, n_live, n_example) of every row: ``base`` and ``spans`` are sorted arrays of
    (start, kind, end, h), kind an index of ``KINDS``; places are code points, ends exclusive.

    ``repo_col`` names the repository (here: the document), ``owner_col`` its owner. Null and empty texts
    have no spans. ``n_live`` and ``n_example`` count the candidates of either sort. A null owner is an owner of its own, a null id a repository of its own. Repeated rows give
    repeated results and count once. Spans that start together are in the order of the kinds. Extra
    columns are not read; an empty table gives an empty table.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(repo_col).cast("long").alias("id"), F.xxhash64(text).alias("digest"), F.col(owner_col).cast("string").alias("owner"), text.alias("t"))
    found = [_found(F.col("t"), k, p, g, least) for k, (_, p, g, least) in enumerate(BASE)]
    rows = rows.select("id", "digest", "owner", F.array_sort(F.concat(*found)).alias("base"), _found(F.col("t"), len(BASE), *TOKEN[1:]).alias("other"))
    rows = stored(_apart(rows), "candidates")

    spans = rows.where(F.size("base") + F.size("other") > 0).select("id", "digest", "owner", F.explode(F.concat("base", "other")).alias("s")).select("id", "digest", "owner", "s.*")
    spans = stored(spans.distinct(), "spans")
    # a value that a third of all rows hold is one row per task, owner and text before it is shuffled
    per_owner = spans.groupBy("h", "owner", "digest").agg(F.count(F.lit(1)).alias("c")).groupBy("h", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("c").alias("c"))
    held = per_owner.groupBy("h").agg((F.max("repos") >= F.lit(LIVE_SHARE) * F.sum("repos")).alias("live"), F.sum("c").alias("c"))
    judged = hot_join(spans, stored(held, "held"), ["h"])
    per_doc = judged.groupBy("id", "digest", "owner").agg(
        F.array_sort(F.collect_list(F.when(F.col("live") & (F.col("kind") == len(BASE)), F.struct("start", "kind", "end", "h")))).alias("added"),
        F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example"),
    )
    d = per_doc.withColumnsRenamed({"id": "_i", "digest": "_d", "owner": "_o"})
    out = rows.join(d, rows["id"].eqNullSafe(d["_i"]) & (rows["digest"] == d["_d"]) & rows["owner"].eqNullSafe(d["_o"]), "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(SPANS))))
    return out.select("id", "base", every.alias("spans"), F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_example", F.lit(0)).alias("n_example"))


def digest_columns(scanned: DataFrame) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example) from :func:`scan_secrets`."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "id", *[count(k).alias(f"n_{name}") for k, (name, *_) in enumerate(BASE)],
        F.sha2(_text_of(F.col("base")).cast("binary"), 256).alias("base_sha256"), _text_of(F.col("spans")).alias("spans"), "n_live", "n_example",
    )
