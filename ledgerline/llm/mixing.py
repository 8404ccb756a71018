"""Mixing sources to target weights by entropy balancing.

Among all document rates ``r`` in [0, 2] with the token constraint ``sum r * size = target`` of each source,
the one nearest to taking every document once (relative entropy) is exponentially tilted:
``r = min(2, exp(lambda * size / scale))``. The multipliers solve the convex dual. Newton's iterations run
over a table of distinct (source, size) with counts, so a hot source or a group of copies is a few rows after
a partial aggregate, and every iteration is one aggregate over that table, safeguarded by a bracket. The rates
are rounded into whole copies (0, 1 or 2) along each source in descending size: copies of a document are the
steps of the rounded running sum of rates, so their words stay within one document's size of the target. What
remains is filled by single copies, largest sizes first, until no document fits. The sums that steer the iterations are
decimals, so they do not depend on the order in which a shuffle delivers, and reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import join_bounded
from ..operators.ordering import dense_positions
from .common import WORD_PATTERN, hot_join, stored

#: Weights of the sources in code-point order, repeated; all sources together get this share of all words.
WEIGHTS, SHARE, CAP = (5.0, 2.0, 1.0), 1.5, 2.0
TOLERANCE = 1e-7
#: Sums of this type are the same in any order; up to 10^28 words.
EXACT = "decimal(38,9)"


def words_in(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, weight, source_size, target) of (source, source_size): weights go round by code point, null
    last; a target above ``CAP`` times its source's size stops there and the excess is shared among the
    others by weight, until none is above. One row per source; only sums come to the driver."""
    order = sizes.withColumn("_last", F.col("source").isNull()).select("_last", "source", "source_size")
    ranked = dense_positions(order, [], ["_last", "source"], "_rank").rows
    w = F.lit(WEIGHTS[-1])
    for k, x in list(enumerate(WEIGHTS))[:-1]:
        w = F.when(F.col("_rank") % len(WEIGHTS) == k, F.lit(x)).otherwise(w)
    weighed = stored(ranked.select("source", w.alias("weight"), "source_size"), "weights")
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = None  # words per weight of the sources that are not at their cap
    while True:
        at_cap = F.lit(False) if level is None else F.col("weight") * level > CAP * F.col("source_size")
        fixed, free = weighed.agg(F.sum(F.when(at_cap, CAP * F.col("source_size")).otherwise(0.0)), F.sum(F.when(at_cap, 0.0).otherwise(F.col("weight")))).first()
        if not free:
            break
        new = (SHARE * total - fixed) / free
        if level is not None and new <= level * (1 + 1e-15):
            break
        level = new
    share = F.lit(0.0) if level is None else F.least(F.col("weight") * F.lit(level), CAP * F.col("source_size"))
    return weighed.withColumn("target", share.cast("double"))


def _solve(hist: DataFrame, goal: DataFrame) -> DataFrame:
    """(source, lam, scale, full): the multiplier of every source; ``full`` sources take every document twice.

    ``hist``: source, size, n; ``goal``: source, source_size, target. The dual's gradient is
    ``sum n * size * r - target``, its curvature ``sum n * size^2 / scale * r`` over documents below the cap.
    """
    moments = hist.groupBy("source").agg(F.sum(F.col("n") * F.col("size") * F.col("size")).cast("double").alias("sq"))
    state = goal.join(moments, goal["source"].eqNullSafe(moments["source"])).select(
        goal["source"], "target", "source_size",
        (F.col("sq") / F.col("source_size")).alias("scale"),  # size-weighted mean size
        F.log(F.greatest(F.col("target") / F.col("source_size"), F.lit(1e-12))).alias("lam"),
        F.lit(None).cast("double").alias("lo"), F.lit(None).cast("double").alias("hi"),
        (F.col("target") >= CAP * F.col("source_size") * (1 - 1e-9)).alias("full"), F.lit(False).alias("done"),
    )
    state = stored(state, "dual")
    while not state.where("not done and not full").isEmpty():
        h = hist.withColumnRenamed("source", "_s")
        x = F.col("size") / F.col("scale")
        tilt = F.exp(F.least(F.col("lam") * x, F.lit(60.0)))
        rate = F.least(tilt, F.lit(CAP))
        joined = state.where("not full and not done").join(h, state["source"].eqNullSafe(F.col("_s")))
        sums = joined.groupBy("_s").agg(
            F.sum((F.col("n") * F.col("size") * rate).cast(EXACT)).cast("double").alias("taken"),
            F.sum(F.when(tilt < CAP, F.col("n") * F.col("size") * x * rate).otherwise(0.0).cast(EXACT)).cast("double").alias("slope"),
        )
        g = F.col("taken") - F.col("target")
        lo = F.when(g < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(g > 0, F.col("lam")).otherwise(F.col("hi"))
        step = F.col("lam") - g / F.col("slope")
        # outside the bracket, or without curvature: bisect, or double where a side is open
        inside = (F.col("slope") > 0) & (F.col("lo").isNull() | (step > F.col("lo"))) & (F.col("hi").isNull() | (step < F.col("hi"))) & (F.abs(step) <= 4 * F.abs(F.col("lam")) + 4)
        back = F.when(F.col("lo").isNull(), F.col("hi") - F.abs(F.col("hi")) - 1).when(F.col("hi").isNull(), F.col("lo") + F.abs(F.col("lo")) + 1).otherwise((F.col("lo") + F.col("hi")) / 2)
        # done too where no number lies between the bracket's ends: every step narrows the bracket or doubles its reach, so this ends
        middle = (F.col("lo") + F.col("hi")) / 2
        near = (F.abs(g) <= TOLERANCE * F.col("target")) | F.coalesce((middle <= F.col("lo")) | (middle >= F.col("hi")), F.lit(False))
        moved = state.join(sums, state["source"].eqNullSafe(F.col("_s")), "left").withColumn("lo", lo).withColumn("hi", hi)
        moved = moved.select(
            "source", "target", "source_size", "scale",
            F.when(F.col("taken").isNull() | near, F.col("lam")).when(inside, step).otherwise(back).alias("lam"),
            "lo", "hi", "full", (F.col("done") | near | F.col("taken").isNull()).alias("done"),
        )
        state = stored(moved.select("source", "target", "source_size", "scale", "lam", "lo", "hi", "full", F.coalesce("done", F.lit(True)).alias("done")), "dual")
    return state.select("source", "lam", "scale", "full")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, source, digest, size, source_size, target, rate, copies): how often the mix takes each document.

    One row per input row. Size is the number of words, 0 for null or blank texts, which are never taken. A
    null source is a source of its own, last in order. Rows that repeat id and text are rounded one
    after the other like any ties of size (ties go by id, then by the text's hash; equal rows are
    interchangeable). Null ids are kept. An empty table gives an empty table. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.xxhash64(F.col(text_col)).alias("digest"), words_in(F.col(text_col)).alias("size"),
    )
    rows = stored(rows, "sizes")
    hist = stored(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    goal = stored(targets(hist.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))), "goal")
    dual = _solve(hist.where("size > 0"), goal.where("source_size > 0"))

    # rates and roundings depend on (source, size) but for the place among equals, so running sums
    # are kept per (source, size) and a document's place gives its step
    d = dual.withColumnRenamed("source", "_s")
    rate = F.when(F.col("full"), F.lit(CAP)).otherwise(F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(60.0))), F.lit(CAP)))
    rated = hist.join(d, hist["source"].eqNullSafe(F.col("_s")), "left").select("source", "size", "n", F.when(F.col("size") > 0, rate).otherwise(F.lit(0.0)).alias("rate"))
    rated = rated.withColumn("rate", F.coalesce("rate", F.lit(0.0)))
    before = _running(rated)
    place = dense_positions(rows, ["source", "size"], ["id", "digest"], "place").rows
    # hot sources, and copies of one text, which share a source and a size, stay where they are
    b = stored(_keyed(before).select(*KEY, "size", "rate", "before", F.col("n").alias("c")), "steps")
    counts = hist.groupBy("source").agg(F.sum("n").alias("c"))
    g = goal.join(counts.withColumnRenamed("source", "_g"), goal["source"].eqNullSafe(F.col("_g")))
    g = stored(_keyed(g).select(*KEY, "source_size", "target", "c"), "goals")
    full = hot_join(hot_join(_keyed(place), b, [*KEY, "size"]), g, KEY)
    step = lambda k: F.floor(F.col("before") + k * F.col("rate") + 0.5 + 1e-9)
    copies = F.greatest(F.lit(0), F.least(F.lit(int(CAP)), step(F.col("place") + 1) - step(F.col("place"))))
    out = stored(full.select("id", "source", "digest", "size", "source_size", "target", "rate", "place", copies.cast("int").alias("copies")), "copies")
    return _corrected(out, goal)


#: A source as two columns that are never null.
KEY = ["_none", "_source"]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_none", F.col("source").isNull()).withColumn("_source", F.coalesce("source", F.lit("")))


def _running(rated: DataFrame) -> DataFrame:
    """Adds ``before``: the rates of all larger documents of the source, only the fraction of which matters.

    The table has one row per source and distinct size; its window is as large as the distinct sizes of a source.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("source").orderBy(F.col("size").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return rated.withColumn("before", F.coalesce(F.sum(F.col("n") * F.col("rate")).over(w), F.lit(0.0)))


def _corrected(out: DataFrame, goal: DataFrame) -> DataFrame:
    """Fills what every source's words still are off by single copies more, or less: from the largest size down, as many
    documents of a size as the rest allows and as have room, until no document fits.

    One pass is a fold over the sizes of a source that are not above its gap, and takes a document once; a
    second pass finds room for the second copy of documents that were not taken.
    """
    while True:
        gap = out.groupBy("source").agg((F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
        gap = stored(gap.where(F.abs("gap") >= 1).select(F.col("source").alias("_s"), F.floor(F.abs("gap")).alias("gap"), F.signum("gap").cast("int").alias("more")), "gap")
        if gap.isEmpty():
            return out.drop("place")
        sizes = out.where("size > 0").groupBy("source", "size").agg(F.count_if(F.col("copies") < int(CAP)).alias("up"), F.count_if(F.col("copies") > 0).alias("down"))
        room = F.when(F.col("more") > 0, F.col("up")).otherwise(F.col("down"))
        sizes = sizes.join(gap, sizes["source"].eqNullSafe(F.col("_s"))).where(F.col("size") <= F.col("gap")).withColumn("room", room).where("room > 0")
        fits = lambda s, x: F.least(x["room"], F.floor(s["left"] / x["size"])).cast("long")
        took = lambda s, x: F.when(fits(s, x) > 0, F.array_append(s["took"], F.struct(x["size"].alias("size"), fits(s, x).alias("m")))).otherwise(s["took"])
        filled = F.aggregate(
            F.reverse(F.array_sort(F.collect_list(F.struct("size", "room")))),
            F.struct(F.first("gap").cast("long").alias("left"), F.array().cast("array<struct<size:bigint,m:bigint>>").alias("took")),
            lambda s, x: F.struct((s["left"] - fits(s, x) * x["size"]).alias("left"), took(s, x).alias("took")),
        )["took"]
        picks = sizes.groupBy("source").agg(F.first("more").alias("more"), filled.alias("took")).select("source", "more", F.explode("took").alias("t")).select("source", "more", "t.*")
        picks = stored(_keyed(picks).drop("source"), "picks")
        if picks.isEmpty():
            return out.drop("place")
        out = stored(_changed(out, picks), "copies")


def _changed(out: DataFrame, picks: DataFrame) -> DataFrame:
    """One copy more (or less) for the first ``m`` documents with room of each picked size."""
    room = F.when(F.col("more") > 0, F.col("copies") < int(CAP)).otherwise(F.col("copies") > 0)
    on = [*KEY, "size"]
    able = join_bounded(_keyed(out), picks, on).where(room)
    ranked = dense_positions(able.select(*on, "place", "m", "more"), on, ["place"], "_nth").rows
    chosen = stored(ranked.where(F.col("_nth") < F.col("m")).select(*on, "place", "more"), "chosen")
    joined = join_bounded(_keyed(out), chosen, [*on, "place"], "left")
    return joined.withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).select(*out.columns)
