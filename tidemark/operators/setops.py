"""Set operations and the rerun-stability check.

States are compared in two levels. Every row has a digest; rows are dealt into
buckets by it, and a bucket is known by its number of rows and order-free sums
of their digests. Equal states cost one map-side aggregation each and no
shuffle of rows; only buckets that differ are compared row by row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StructType, VariantType

# Buckets of a fingerprint; a fingerprint has at most as many rows.
BUCKETS = 4096


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """O3: distinct rows of ``left`` absent from ``right`` (NULLs compare equal)."""
    return left.subtract(right)


def union_by_name(left: DataFrame, right: DataFrame, allow_missing: bool = True) -> DataFrame:
    """Union by column name; missing columns become NULL when allowed."""
    return left.unionByName(right, allowMissingColumns=allow_missing)


def _text(c: Column, dtype: DataType) -> Column:
    if isinstance(dtype, ArrayType | MapType | StructType | VariantType):
        return F.to_json(F.struct(c))
    return F.hex(c) if isinstance(dtype, BinaryType) else c.cast("string")


def row_digest(df: DataFrame) -> Column:
    """md5 of a row: per column, in order, its text's length and text, ``-`` for NULL."""
    parts = []
    for f in df.schema:
        text = _text(F.col(f"`{f.name}`"), f.dataType)
        parts.append(F.coalesce(F.concat(F.char_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat(*parts))


def _number(digest: Column, at: int) -> Column:
    """15 hex digits of a digest as a number."""
    return F.conv(F.substring(digest, at, 15), 16, 10).cast("long")


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    with_digest = df.withColumn("_digest", row_digest(df))
    return with_digest.withColumn("_bucket", _number(F.col("_digest"), 1) % buckets)


def state_fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """O7, first level: per non-empty bucket ``n_rows`` and two sums over its rows' digests."""
    each = _bucketed(df, buckets)
    sums = [F.sum(_number(F.col("_digest"), at).cast("decimal(38,0)")).alias(name) for name, at in (("sum_low", 1), ("sum_high", 17))]
    return each.groupBy(F.col("_bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def changed_buckets(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Buckets whose fingerprints differ, at most ``buckets`` of them."""
    marks = ["n_rows", "sum_low", "sum_high"]
    a = state_fingerprint(before, buckets).select("bucket", F.struct(*marks).alias("a"))
    b = state_fingerprint(after, buckets).select("bucket", F.struct(*marks).alias("b"))
    differ = a.join(b, "bucket", "full_outer").filter(~F.col("a").eqNullSafe(F.col("b")))
    return [r["bucket"] for r in differ.select("bucket").collect()]


def state_diff(before: DataFrame, after: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """Rows only in ``before`` and rows only in ``after`` (multiset, both directions).

    Rows of a repeated number count as often as they stand there. The two
    sides need the same columns; their types are taken from ``before``.
    """
    cols = before.columns
    after = after.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in before.schema])
    changed = changed_buckets(before, after, buckets)
    if not changed:
        return before.limit(0), after.limit(0)
    left, right = (_bucketed(df, buckets).filter(F.col("_bucket").isin(changed)).select(*cols) for df in (before, after))
    return left.exceptAll(right), right.exceptAll(left)


def assert_idempotent(fn: Callable[[DataFrame, DataFrame], DataFrame], state: DataFrame, batch: DataFrame) -> DataFrame:
    """Apply ``fn(state, batch)`` twice and require the second pass to change nothing.

    Returns the first result. The comparison goes both ways: a one-way
    ``EXCEPT`` would miss rows the second pass adds.
    """
    once = fn(state, batch)
    twice = fn(once, batch)
    gone, added = state_diff(once, twice)
    if not gone.isEmpty() or not added.isEmpty():
        raise AssertionError("operation is not idempotent: a second pass changed the state")
    return once
