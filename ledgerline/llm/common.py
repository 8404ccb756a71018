"""Helpers shared by the operators of this subpackage: reading tables, scratch tables, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

#: The white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


#: Most bytes of one Arrow batch that goes to a Python worker (one row may be longer).
BATCH_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready(spark: SparkSession) -> None:
    """Makes this package importable in the Python workers, and bounds the batches that the session sends
    them by bytes: 10,000 rows of text, the default, may be any size, in the executor and in the worker."""
    ship_package(spark)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if parse_bytes(spark.conf.get(setting, None)) > BATCH_BYTES:
        spark.conf.set(setting, str(BATCH_BYTES))


def parse_bytes(value: str | None) -> float:
    """A size setting such as ``64MB`` or ``1048576b`` in bytes; unset is without bound."""
    if not value:
        return float("inf")
    digits = value.strip().lower().rstrip("bkmgt")
    unit = value.strip().lower()[len(digits):].rstrip("b")
    return int(digits) * 1024 ** " kmgt".index(unit or " ")


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` with Arrow's unused memory given back when a task ends: workers wait for later tasks, and
    what they hold meanwhile counts against their executor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()

    return task


#: Folders written within the open :func:`scratch` blocks, innermost last.
_open: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Removes the tables that :func:`stored` writes within the block when it ends, but for those with ``keep``,
    which belong to the block around it. What leaves the block must read kept tables only."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written to a fresh folder below ``spark.checkpoint.dir`` and read back: cuts the lineage
    in a place that every executor sees, so a lost executor costs no recomputation of what is behind it."""
    path = scratch_path(df.sparkSession, "llm", name)
    blocks = _open[:-1] if keep else _open
    if blocks:
        blocks[-1].append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_join(rows: DataFrame, keys: DataFrame, on: list[str], least: int = 1000) -> DataFrame:
    """Inner join of ``rows`` with a stored table of one row per key, whose column ``c`` says how many rows have that key.

    Keys of a thousandth of all rows or more (at most a thousand of them, ``least`` rows each) are broadcast, so their
    rows stay where they are; only the rows of other keys are shuffled. ``c`` is not returned.
    """
    total = keys.agg(F.sum("c")).first()[0] or 0
    bound = max(least, -(-total // 1000))
    hot, cold = keys.where(F.col("c") >= bound).drop("c"), keys.where(F.col("c") < bound).drop("c")
    if hot.isEmpty():
        return rows.join(cold, on)
    apart = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(cold, on)
    return rows.join(F.broadcast(hot), on).unionByName(apart)


def crc32_mod(column, mod: int):
    """crc32 of the value as text, modulo ``mod`` (the folds of the classifiers)."""
    return F.crc32(column.cast("string").cast("binary")) % F.lit(mod)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of ``edges`` (long columns ``a``, ``b``) as (node, comp): comp is the
    smallest node of the component. Nodes without an edge are not listed.

    Every round hooks each node to its smallest neighbour (a partial aggregate, so a hot node costs
    one row per task), follows the hooks to their roots by pointer doubling, and contracts the edges
    to the roots. At least half of the nodes that still have edges vanish per round, so the number
    of rounds grows with the logarithm of the input. All state is in written tables; only counts
    come to the driver. Self loops and repeated edges are allowed, null ends are dropped.
    """
    with scratch(edges.sparkSession):
        return stored(_contracted(edges, name), name, keep=True)


def _contracted(edges: DataFrame, name: str) -> DataFrame:
    left = stored(
        edges.where("a is not null and b is not null and a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        name,
    )
    maps: list[DataFrame] = []
    while not left.isEmpty():
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        hook = stored(hook, name)
        while True:  # pointer doubling until every hook ends in a root
            up = hook.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = stored(hook.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), name)
            still = not jumped.where("moved").isEmpty()
            hook = jumped.select("node", "root")
            if not still:
                break
        maps.append(hook)
        on_a = hook.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        on_b = hook.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        left = stored(
            left.join(on_a, "a").join(on_b, "b").where("ra <> rb")
            .select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            name,
        )
    if not maps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    out = maps[0].select("node", F.col("root").alias("comp"))
    for later in maps[1:]:
        nxt = later.select(F.col("node").alias("comp"), F.col("root").alias("_ll_up"))
        out = out.join(nxt, "comp", "left").select("node", F.coalesce("_ll_up", "comp").alias("comp"))
    return out
