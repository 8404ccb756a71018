"""Small column helpers of the producer side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def new_key() -> Column:
    """a random UUID string per row (non-deterministic: a retried task makes new keys)."""
    return F.expr("uuid()")


def stable_key(*cols: str) -> Column:
    """F4 for tests and replays: a UUID-shaped key derived from the row's own columns."""
    h = F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in cols]), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def random_index(seed: int | None = None) -> Column:
    """a random 32-bit integer per row (``seed`` makes it repeatable for a fixed partitioning)."""
    r = F.rand(seed) if seed is not None else F.rand()
    return (F.floor(r * F.lit(2**32)) - F.lit(2**31)).cast("int")


def stable_index(*cols: str) -> Column:
    """F6 for tests and replays: a 32-bit integer derived from the row's own columns."""
    h = F.sha2(F.concat_ws("\u0001", *[F.col(c).cast("string") for c in cols]), 256)
    return (F.conv(F.substring(h, 33, 8), 16, 10).cast("long") - F.lit(2**31)).cast("int")


def labelled(prefix: str, col: Column) -> Column:
    """``prefix + value`` as the producer builds author/description/text."""
    return F.concat(F.lit(prefix), col.cast("string"))


def next_offset(offset: Column) -> Column:
    """the committable position after a record."""
    return offset + F.lit(1)
