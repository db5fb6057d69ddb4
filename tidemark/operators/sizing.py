"""Size-checked broadcast.

A broadcast hint is only placed after a bounded look proves the side small in
rows and in bytes: at most ``max_rows + 1`` rows are read, so checking a huge
side costs no more than checking a small one. Sides above the bound are left
to the planner (sort-merge join, or AQE's runtime broadcast).

Hinting at planning time matters when the small side is only known to be
small after it is computed (a daily batch, its distinct keys): without the
hint the big side is shuffled before AQE sees the small side's size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

# Largest side broadcast after the bounded look.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Reckoned size of one value: exact enough for numbers and dates, a start for texts.
KEY_COLUMN_BYTES = 32
_FIXED_BYTES = 16


def rows_within(bytes_per_row: int) -> int:
    """Rows of that size that the byte bound allows."""
    return BROADCAST_MAX_BYTES // max(1, bytes_per_row)


def _measured(df: DataFrame):
    """Bytes of one row: texts and nested values by their length, others at a fixed size."""
    total = F.lit(_FIXED_BYTES)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType | BinaryType):
            total = total + F.coalesce(F.octet_length(c), F.lit(0)) + _FIXED_BYTES
        elif isinstance(f.dataType, ArrayType | MapType | StructType):
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)) + _FIXED_BYTES
        else:
            total = total + _FIXED_BYTES
    return total.cast("long")


def row_bytes(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> int:
    """Bytes of at most ``max_rows + 1`` rows of ``df``."""
    return int(df.limit(max_rows + 1).agg(F.sum(_measured(df))).first()[0] or 0)


def is_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """Whether ``df`` provably holds at most ``max_rows`` rows and the byte bound."""
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(_measured(df))).first()
    return n <= max_rows and (size or 0) <= BROADCAST_MAX_BYTES


def broadcast_if_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if ``df`` is within the bounds, else ``df``."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df
