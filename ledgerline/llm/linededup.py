"""Line dedup by a log-template tree, in DataFrame functions only.

Every line walks a tree of fixed depth: its number of tokens, then its first ``LEAD`` tokens, where the part of
a token from its first digit on is the variable ``<*>``. A leaf holds the shapes of its lines: all tokens,
generalised in the same way. Three kinds of template come out of a leaf:

* a shape (a line with its variable tokens generalised), if at least ``SHAPE_CONSTANT`` of its tokens, and
  ``MIN_CONSTANT`` of them, hold no variable,
* a leaf's lines with a few of their positions masked: the positions behind the leading tokens lie in at most
  ``PARTS`` parts (one position each, in lines of up to ``LEAD + PARTS`` tokens), and each choice of one or two
  parts gives a template, if at least ``CONSTANT`` of these positions, and ``MIN_CONSTANT`` of them, are neither
  masked nor hold a variable. So a leaf has as many templates as it has kinds of line, and whether some lines
  recur does not depend on others, and
* a line as it is, if it has no other template: rows of numbers recur only as a whole, and so do lines of fewer
  than ``SHORT_TOKENS`` tokens, from ``SHORT_DOCS`` documents on.

A template found in at least ``MIN_DOCS`` distinct documents recurs, and so does a line of at least
``LONG_TOKENS`` tokens that stands as it is in ``LONG_DOCS``: its lines are dropped everywhere but in
the first place (smallest document, then line), so the corpus keeps one instance. All counts are partial
aggregates keyed by hashes. Masks are made of distinct shapes only, each with two of its documents (a shape in
more recurs anyway, and so do its masks), so a line that a third of all documents hold costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from .common import scratch, stored

MIN_DOCS = 3
#: A passage this long is no chance: two documents that hold it suffice.
LONG_TOKENS, LONG_DOCS = 50, 2
LEAD = 3
#: Lines with fewer tokens recur by chance: they have no template, and as they are they recur from this many documents on.
SHORT_TOKENS, SHORT_DOCS = 4, 8
#: Parts of the positions behind the leading tokens.
PARTS = 16
CONSTANT, SHAPE_CONSTANT = 0.75, 0.5
#: Fewest constant tokens of a template that generalises.
MIN_CONSTANT = 3
#: The variable part of a token: from its first digit on.
VARIABLE = r"[0-9][^\x20\x09-\x0D]*+"
#: White space within a line that is not one space already.
BLANKS = r"[\x20\x09\x0B-\x0D]{2,}+|[\x09\x0B-\x0D]"


def _doc_key(id_col: str, text_col: str) -> list[Column]:
    return [F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("digest")]


def line_templates(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line with a token: id, digest, line (from 0), n, leaf, exact, shape, general (may the
    shape be a template), masked (may some of its tokens be masked)."""
    text = F.col(text_col).cast("string")
    # shaped before the lines are split: what a generator returns is not computed again for each use
    split = lambda t: F.arrays_zip(F.split(F.regexp_replace(t, VARIABLE, "<*>"), "\n").alias("shape"), F.split(t, "\n").alias("exact"))
    both = F.get(F.transform(F.array(F.regexp_replace(text, BLANKS, " ")), split), F.lit(0))
    lines = docs.where(text.isNotNull()).select(*_doc_key(id_col, text_col), F.posexplode(both).alias("line", "raw"))
    shaped = lines.select("id", "digest", "line", F.btrim("raw.shape").alias("shape"), F.btrim("raw.exact").alias("exact"))
    n = F.when(F.col("shape") == "", 0).otherwise(F.length("shape") - F.length(F.replace("shape", F.lit(" "), F.lit(""))) + 1)
    shaped = shaped.withColumn("n", n).where(F.col("n") > 0)
    lead = F.substring_index("shape", " ", LEAD)
    fixed = F.col("n") - ((F.length("shape") - F.length(F.replace("shape", F.lit("<*>"), F.lit("")))) / 3).cast("int")
    general = (F.col("n") >= SHORT_TOKENS) & (fixed >= MIN_CONSTANT) & (fixed >= F.col("n") * SHAPE_CONSTANT)
    m = F.col("n") - LEAD
    masked = (m - 1 >= m * CONSTANT) & (m - 1 >= MIN_CONSTANT) & (fixed >= MIN_CONSTANT)
    return shaped.select(
        "id", "digest", "line", "n", F.xxhash64("n", lead).alias("leaf"), F.xxhash64(F.lit("line"), "exact").alias("exact"),
        F.xxhash64(F.lit("shape"), "n", "shape").alias("shape"), general.alias("general"), masked.alias("masked"),
    )


def _parts(tokens: Column) -> Column:
    """Array of (h, held) of the parts of ``tokens`` behind the leading ones."""
    m = F.size(tokens) - LEAD
    k = F.least(m, F.lit(PARTS))
    begin = lambda p: F.floor(p * m / k).cast("int")

    def part(p: Column) -> Column:
        own = F.slice(tokens, begin(p) + LEAD + 1, begin(p + 1) - begin(p))
        return F.struct(F.xxhash64(own).alias("h"), F.size(F.filter(own, lambda t: ~F.contains(t, F.lit("<*>")))).alias("held"))

    return F.transform(F.sequence(F.lit(0), k - 1), part)


#: Each two of four quarters of the parts, and by the quarters of two parts the pairs (as bits) that hold neither.
HALVES = [(a, b) for a in range(4) for b in range(a + 1, 4)]
OPEN = [sum(1 << k for k, half in enumerate(HALVES) if a not in half and b not in half) for a in range(4) for b in range(4)]


def _halves(parts: Column) -> Column:
    """Hashes of each two of four quarters of the parts: two masked parts leave one of these pairs whole."""
    hashes, k = F.transform(parts, lambda p: p["h"]), F.size(parts)
    begin = lambda q: F.floor(k * q / 4).cast("int")
    quarter = lambda q: F.slice(hashes, begin(q) + 1, begin(q + 1) - begin(q))
    return F.array(*[F.xxhash64("leaf", F.lit(4 * a + b), quarter(a), quarter(b)) for a, b in HALVES])


def _masks(n: Column, parts: Column, halves: Column) -> Column:
    """Hashes of the masked forms: pairs i <= j of parts, written as one number, that leave one of the ``halves``
    (as bits) whole; no other form is one of two shapes."""
    k = F.size(parts)
    quarter = lambda x: sum((x >= F.floor(k * q / 4)).cast("int") for q in (1, 2, 3))
    opened = F.array(*[F.lit(x) for x in OPEN])
    i, j = (lambda x: F.floor(x / k).cast("int")), (lambda x: x % k)
    held = F.aggregate(parts, F.lit(0), lambda a, p: a + p["held"])

    def may(x: Column) -> Column:
        left = held - parts[i(x)]["held"] - F.when(i(x) < j(x), parts[j(x)]["held"]).otherwise(0)
        whole = F.get(opened, quarter(i(x)) * 4 + quarter(j(x))).bitwiseAND(halves) != 0
        return (i(x) <= j(x)) & whole & (left >= MIN_CONSTANT) & (left >= (n - LEAD) * CONSTANT)

    form = lambda x: F.xxhash64("leaf", x, F.transform(parts, lambda p, at: F.when((at != i(x)) & (at != j(x)), p["h"])))
    return F.transform(F.filter(F.sequence(F.lit(0), k * k - 1), may), form)


def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("nil"), "id", "digest", "line")


def _often(key: str, of: DataFrame, least: Column) -> DataFrame:
    """(key, first place) of the keys in at least ``least`` distinct documents, by the key's tokens ``n``; counted after a partial aggregate per (key, document)."""
    per_doc = of.groupBy(key, "n", "id", "digest").agg(F.min("line").alias("line"))
    return per_doc.groupBy(key, "n").agg(F.count(F.lit(1)).alias("docs"), F.min(_place()).alias("first")).where(F.col("docs") >= least).select(key, "first")


def _shared(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key several shapes have, in enough documents if all are apart."""
    keys = rows.groupBy(key).agg(F.min("shape").alias("a"), F.max("shape").alias("b"), F.sum("docs").alias("docs"))
    return rows.join(keys.where((F.col("a") != F.col("b")) & (F.col("docs") >= MIN_DOCS)).select(key), key, "left_semi")


def _shape_texts(docs: DataFrame, places: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``places`` (a row per shape, with its first place) and ``form``, the shape as text: read again from the
    documents of these places, so that no line's text is stored or shuffled by its shape."""
    held = places.groupBy(F.col("first.id").alias("_id"), F.col("first.digest").alias("_digest")).agg(F.collect_list(F.struct(*places.columns)).alias("held"))
    held = stored(held, "held")
    text = F.col(text_col).cast("string")
    rows = docs.where(text.isNotNull()).select(*_doc_key(id_col, text_col), F.regexp_replace(text, BLANKS, " ").alias("t"))
    same = lambda x: rows["id"].eqNullSafe(x["_id"]) & (rows["digest"] == x["_digest"])
    keys = held.select("_id", "_digest")
    rows = join_bounded(rows, keys, same(keys), "left_semi")
    pieces = lambda p: F.transform("held", lambda h: F.struct(h.alias("h"), F.get(p, h["first"]["line"]).alias("t")))
    # the text is split once for all lines of it
    found = rows.join(held, same(held)).select(F.explode(F.get(F.transform(F.array(F.split("t", "\n")), pieces), F.lit(0))).alias("x"))
    return found.select("x.h.*", F.btrim(F.regexp_replace("x.t", VARIABLE, "<*>")).alias("form")).dropDuplicates(["shape"])


def recurring(lines: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(exact, first place) of lines that recur as they are, and (shape, first place) of those that recur by
    their shape or a masked form of it: of all that do, the earliest place."""
    doc = ["nil", "id", "digest"]
    per_doc = lines.groupBy("shape", "leaf", "n", "general", "masked", "id", "digest").agg(F.min("line").alias("line"))
    shapes = per_doc.groupBy("shape", "leaf", "n", "general", "masked").agg(F.count(F.lit(1)).alias("docs"), F.min(_place()).alias("first"), F.max(_place()).alias("last"))
    shapes = stored(shapes, "shapes")
    # leaves of several shapes in enough documents; a shape in two documents is in its first and last
    few = _shape_texts(docs, _shared(shapes.where("masked"), "leaf").select("shape", "leaf", "n", "docs", "first", "last"), id_col, text_col)
    parts = F.get(F.transform(F.array(F.split("form", " ")), _parts), F.lit(0))
    few = stored(few.select("leaf", "n", "shape", "docs", "first", "last", parts.alias("parts")), "few")
    # a masked form recurs only with another shape that has half of its parts
    near = _shared(few.select("shape", "docs", F.posexplode(_halves(F.col("parts"))).alias("k", "half")), "half")
    near = near.groupBy("shape").agg(F.bit_or(F.expr("shiftleft(1, k)")).alias("halves"))
    few = few.join(near, "shape")
    forms = stored(few.select("shape", "docs", "first", "last", F.explode(_masks(F.col("n"), F.col("parts"), F.col("halves"))).alias("form")), "forms")
    forms = stored(_shared(forms, "form"), "forms")
    ends = forms.select("form", "docs", "first", F.explode(F.array("first", "last")).alias("d")).groupBy("form", *[F.col(f"d.{c}").alias(c) for c in doc]).agg(F.max("docs").alias("docs"), F.min("first").alias("first"))
    masked = ends.groupBy("form").agg(F.count(F.lit(1)).alias("distinct"), F.max("docs").alias("docs"), F.min("first").alias("first"))
    masked = masked.where((F.col("distinct") >= MIN_DOCS) | (F.col("docs") >= MIN_DOCS)).select("form", "first")
    by_form = forms.select("form", "shape").join(masked, "form").select("shape", "first")
    by_shape = shapes.where(F.col("general") & (F.col("docs") >= MIN_DOCS)).select("shape", "first")
    chosen = stored(by_form.unionAll(by_shape).groupBy("shape").agg(F.min("first").alias("first")), "templates")
    # a short line of a general shape recurs no more often than its shape
    whole = lines.where(~F.col("general") | (F.col("n") >= LONG_TOKENS)).join(chosen, "shape", "left_anti")
    return _often("exact", whole, F.when(F.col("n") >= LONG_TOKENS, LONG_DOCS).when(F.col("n") < SHORT_TOKENS, SHORT_DOCS).otherwise(MIN_DOCS)), chosen


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, lines): the numbers of the lines to drop, one row per distinct document with any."""
    # rows that repeat id and text fall together where documents are counted
    lines = stored(line_templates(docs, id_col, text_col), "lines")
    exacts, shapes = recurring(lines, docs, id_col, text_col)
    exacts = stored(exacts, "templates")
    away = _place() != F.col("first")
    by_exact = lines.join(exacts, "exact").where(away).select("id", "digest", "line")
    by_shape = lines.join(shapes, "shape").where(away).select("id", "digest", "line")
    # the first place of a template may have an earlier one by another of its masked forms: it stays
    first = shapes.select("first").unionAll(exacts.select("first")).distinct().select("first.*")
    gone = by_exact.unionAll(by_shape).distinct()
    keep = [gone["id"].eqNullSafe(first["id"]), gone["digest"] == first["digest"], gone["line"] == first["line"]]
    gone = gone.join(first, keep[0] & keep[1] & keep[2], "left_anti")
    return gone.groupBy("id", "digest").agg(F.array_sort(F.collect_list("line")).alias("lines"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with ``text_col`` less its recurring lines, and ``_ll_dropped`` (int).

    A line ends at a line feed; the kept lines stay joined by line feeds, in order. Null and empty texts
    stay as they are. Rows that repeat id and text get the same result and count as one document; a
    null id counts as the last one. Of ties the smaller id, then text hash, then line is the first place.
    Extra columns of any name are carried along. An empty table gives an empty table.
    """
    with scratch(docs.sparkSession):
        gone = stored(dropped_lines(docs, id_col, text_col), "dropped", keep=True)
    g = gone.select(F.col("id").alias("_ll_id"), F.col("digest").alias("_ll_digest"), F.col("lines").alias("_ll_lines"))
    on = F.col(id_col).cast("long").eqNullSafe(F.col("_ll_id")) & (F.xxhash64(F.col(text_col)) == F.col("_ll_digest"))
    joined = docs.join(g, on, "left")
    pieces = F.split(F.col(text_col), "\n")
    kept = F.array_join(F.filter(pieces, lambda x, i: ~F.array_contains(F.col("_ll_lines"), i)), "\n")
    text = F.when(F.col("_ll_lines").isNull(), F.col(text_col)).otherwise(kept)
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in docs.columns], F.coalesce(F.size("_ll_lines"), F.lit(0)).alias("_ll_dropped"))
