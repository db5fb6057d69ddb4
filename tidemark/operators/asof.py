"""Point-in-time joins of facts to half-open validity intervals.

``fact.date`` must fall in ``[valid_from, valid_to)`` of a dimension version
of the same key. A plain equi join on the key compares every fact with every
version of its key — all pairs of a group. Here the join key is widened by a
calendar bucket (month): each closed version is listed once per month it
overlaps, each fact once, so a fact is compared only with the versions that
overlap its month (for day-grain histories at most 32). Open versions (at
most one per key) are listed up to the latest fact month, so a hot key's
facts spread over its months in every case. Nothing is broadcast unless the
planner proves it small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import OPEN_END


def month_index(c: Column) -> Column:
    """Months since year 0 — a monotone calendar bucket for dates and timestamps."""
    return F.year(c) * 12 + F.month(c) - 1


def calendar_bucket(c: Column, grain: str = "month") -> Column:
    """Monotone calendar bucket number of a date/timestamp: month, quarter or year.

    A coarser grain lists each version in fewer buckets (fewer dimension rows)
    but compares a fact with more versions (at most one per day of the bucket
    for day-grain histories).
    """
    if grain == "month":
        return month_index(c)
    if grain == "quarter":
        return F.year(c) * 4 + F.quarter(c) - 1
    if grain == "year":
        return F.year(c)
    raise ValueError("grain must be 'month', 'quarter' or 'year'")


def _open(vt: Column, open_end) -> Column:
    cond = vt.isNull()
    if open_end is not None:
        cond = cond | (vt >= F.lit(open_end))
    return cond


def _months(vf: Column, vt: Column) -> Column:
    return F.explode(F.sequence(month_index(vf), month_index(vt)))


def asof_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    fact_date: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    open_end=OPEN_END,
    horizon=None,
    grain: str = "month",
) -> DataFrame:
    """Inner join of each fact with the dimension version valid at ``fact_date``.

    ``open_end``: sentinel marking an open version (default 9999-12-31; any
    end at or after it is open); NULL ``valid_to`` is always open. Open versions are listed up to the
    ``horizon`` bucket: the given date's, else the latest fact bucket (a
    scalar subquery over the fact dates). Facts and versions after the
    horizon share its bucket, so a horizon only bounds the buckets listed. One equi join on ``(keys,
    bucket)`` with ``grain`` month (default), quarter or year; the facts are
    shuffled once. Output: all fact columns plus the dimension's non-key
    columns.
    """
    dcols = [c for c in dim.columns if c not in keys]
    f = facts.withColumn("_m", calendar_bucket(F.col(fact_date), grain))
    if horizon is None:
        last = f.select(F.max("_m")).scalar()
    else:
        last = calendar_bucket(F.lit(horizon), grain)
        f = f.withColumn("_m", F.least("_m", last))
    vf, vt = F.col(valid_from), F.col(valid_to)
    is_open = _open(vt, open_end)
    first_m, end_m = calendar_bucket(vf, grain), calendar_bucket(vt, grain)
    if horizon is not None:
        first_m, end_m = F.least(first_m, last), F.least(end_m, last)
    last_m = F.when(is_open, F.greatest(first_m, last)).otherwise(end_m)
    d = (
        dim.filter(is_open | (vf < vt))
        .select(
            *[F.col(k).alias(f"_dk_{k}") for k in keys],
            *dcols,
            is_open.alias("_open"),
            F.explode(F.sequence(first_m, last_m)).alias("_dm"),
        )
    )
    fd = F.col(fact_date)
    cond = (F.col("_m") == F.col("_dm")) & (fd >= vf) & (F.col("_open") | (fd < vt))
    for k in keys:
        cond = cond & (f[k] == F.col(f"_dk_{k}"))
    return f.join(d, cond, "inner").select(*facts.columns, *dcols)


def inside_closed(
    events: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    event_date: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    open_end=OPEN_END,
) -> DataFrame:
    """Events whose date falls inside a *closed* version of their key (left semi)."""
    d = dim.select(
        *[F.col(k).alias(f"_dk_{k}") for k in keys],
        F.col(valid_from).alias("_vf"),
        F.col(valid_to).alias("_vt"),
    )
    closed = d.filter(~_open(F.col("_vt"), open_end) & (F.col("_vf") < F.col("_vt"))).withColumn(
        "_dm", _months(F.col("_vf"), F.col("_vt"))
    )
    e = events.withColumn("_em", month_index(F.col(event_date)))
    cond = (F.col("_em") == F.col("_dm")) & (F.col(event_date) >= F.col("_vf")) & (
        F.col(event_date) < F.col("_vt")
    )
    for k in keys:
        cond = cond & (e[k] == F.col(f"_dk_{k}"))
    return e.join(closed, cond, "left_semi").drop("_em")
