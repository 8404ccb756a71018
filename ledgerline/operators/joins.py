"""Joins against a small side whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast side above this many rows, or this many estimated bytes, goes through a shuffle join.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


def _default_size(dt: T.DataType) -> int:
    """Estimated bytes of one value, after Spark's per-type defaults (a string counts 20 bytes)."""
    if isinstance(dt, T.StructType):
        return sum(_default_size(f.dataType) for f in dt.fields)
    if isinstance(dt, (T.ArrayType, T.MapType, T.BinaryType)):
        return 100
    if isinstance(dt, T.DecimalType):
        return 8 if dt.precision <= 18 else 16
    if isinstance(dt, (T.StringType, T.VariantType)):
        return 20
    if isinstance(dt, (T.BooleanType, T.ByteType, T.NullType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    return 8


def estimated_bytes(df: DataFrame, rows: int) -> int:
    """Rows times the estimated size of one row."""
    return rows * sum(_default_size(f.dataType) for f in df.schema.fields)


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: list[str] | Column,
    how: str = "inner",
    max_rows: int = BROADCAST_MAX_ROWS,
    rows: int | None = None,
    max_bytes: int = BROADCAST_MAX_BYTES,
) -> DataFrame:
    """Broadcast ``small`` only when its row count (given, or counted here) is within ``max_rows`` and
    its estimated size within ``max_bytes``.

    ``small`` should be materialised (checkpointed or a stored table) so that the count is cheap.
    Beyond the bounds the join is left to Catalyst/AQE as a shuffle join.
    """
    n = small.count() if rows is None else rows
    fits = n <= max_rows and estimated_bytes(small, n) <= max_bytes
    side = F.broadcast(small) if fits else small
    return big.join(side, on, how)


def fits_broadcast(df: DataFrame, rows: int, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """The same bound as :func:`join_bounded`, for callers that plan their own join."""
    return rows <= max_rows and estimated_bytes(df, rows) <= max_bytes
