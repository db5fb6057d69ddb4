"""Scalar expression helpers: safe casts, dates, exact sums, hash keys.

Aggregates of floating-point columns depend on the order rows arrive in, and
that order changes with the partitioning of a 1000-executor run. Where a
column has a known number of decimals (prices, discounts) the helpers here
sum it as DECIMAL, which is exact and therefore identical on every rerun —
the property the idempotency checks rely on.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the open end of a slowly-changing history slice.
OPEN_END = _dt.date(9999, 12, 31)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(c: Column | str, dtype: str) -> Column:
    """ANSI-safe cast; an uncastable value becomes NULL instead of failing the job."""
    return col(c).try_cast(dtype)


def as_date(c: Column | str) -> Column:
    """timestamp, date or ISO string -> DATE."""
    return F.to_date(col(c))


def days_between(end: Column | str, start: Column | str) -> Column:
    """whole days from ``start`` to ``end``."""
    return F.datediff(col(end), col(start))


def exact_sum(c: Column | str, scale: int | None) -> Column:
    """SUM with a deterministic result.

    ``scale`` given: the values are summed as DECIMAL(38-ish, scale), exactly,
    then returned as DOUBLE. ``scale`` None: a plain DOUBLE sum.
    """
    if scale is None:
        return F.sum(col(c).cast("double"))
    return F.sum(col(c).cast(f"decimal(18,{scale})")).cast("double")


def exact_avg(c: Column | str, scale: int | None) -> Column:
    """AVG = exact sum / count of non-null values (DOUBLE); NULL on no values."""
    n = F.count(col(c))
    return F.when(n > 0, exact_sum(c, scale) / n)


def hash_key(c: Column | str, trim: bool = True) -> Column:
    """hex md5 surrogate key of a (trimmed) natural key."""
    value = F.trim(col(c)) if trim else col(c)
    return F.md5(value.cast("string"))


def null_safe_differs(left: Column, right: Column) -> Column:
    """True when two values differ, treating NULL as a value (trap T6)."""
    return ~left.eqNullSafe(right)
