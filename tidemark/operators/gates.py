"""Integrity gates (G1-G4, A6, G3) — the only eager points of a load.

Each gate is one small Spark job that stops at the first offending row
(``limit(1)``). Duplicate detection is a ``groupBy(keys).count()``: the
partial (map-side) aggregation collapses a hot key to one row per input
partition before the shuffle, so a key holding a third of all rows costs
no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import MSG_PK_COLLISION, FutureDateError, IntraBatchDuplicateError, SCD2TimelineException
from tidemark.operators.dedup import collapse, comparable
from tidemark.session import cut_lineage


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys occurring more than once, with their row count ``n_rows``."""
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
    )


def first_duplicate(df: DataFrame, keys: Sequence[str]):
    rows = duplicate_keys(df, keys).limit(1).collect()
    return rows[0] if rows else None


def future_date_gate(df: DataFrame, date_col: Column | str, bound) -> None:
    """G1: raise :class:`FutureDateError` when any date is strictly after ``bound``."""
    bound_col = bound if isinstance(bound, Column) else F.lit(bound)
    hit = df.filter(_col(date_col) > bound_col).limit(1).count()
    if hit:
        raise FutureDateError(f"Record dated after {bound} blocked at the validation gate.")


def validate_composite_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Any repeated composite key fails, exact copies included."""
    dup = first_duplicate(df, keys)
    if dup is not None:
        shown = ", ".join(f"{k}={dup[k]!r}" for k in keys)
        raise IntraBatchDuplicateError(f"Key ({shown}) occurs {dup['n_rows']} times in one batch")


def validate_fact_composite_keys(fact_df: DataFrame, composite_pks: Sequence[str]) -> None:
    """G2 under its original name."""
    validate_composite_keys(fact_df, composite_pks)


def scd2_batch_overlap_gate(df: DataFrame, keys: Sequence[str], eff_col: str) -> None:
    """Two events for one key on one effective date contradict each other."""
    dup = first_duplicate(df, [*keys, eff_col])
    if dup is not None:
        raise SCD2TimelineException(
            f"Two events for one key on the same {eff_col} in the batch: {dict(dup.asDict())}"
        )


def dedupe_batch(df: DataFrame, pk: str) -> DataFrame:
    """Exact copies collapse; one PK with different attributes fails; NULL PK fails.

    One hash aggregation over fixed-width values: per PK the rows and the
    smallest and largest of two 64-bit row hashes, which differ exactly when
    the PK carries different attribute profiles. Only repeated PKs are kept of
    it; they also tell which rows to collapse. Returns one row per PK.
    """
    others = [c for c in df.columns if c != pk]
    row = comparable(df, others)
    hashes = [F.xxhash64(F.lit(seed), *row) for seed in (1, 2)]
    ends = [agg(h).alias(f"_{name}{i}") for i, h in enumerate(hashes) for name, agg in (("lo", F.min), ("hi", F.max))]
    grouped = df.groupBy(F.col(pk).alias("_rk0")).agg(F.count(F.lit(1)).alias("_n"), *ends)
    repeated = cut_lineage(grouped.filter(F.col("_rk0").isNull() | (F.col("_n") > 1)))
    differs = (F.col("_lo0") != F.col("_hi0")) | (F.col("_lo1") != F.col("_hi1"))
    bad = repeated.filter(F.col("_rk0").isNull() | differs).limit(1).collect()
    if bad:
        if bad[0]["_rk0"] is None:
            raise ValueError(f"NULL primary key {pk!r} in batch")
        raise IntraBatchDuplicateError(
            f"{MSG_PK_COLLISION} on {pk}={bad[0]['_rk0']!r}: two different rows share the key"
        )
    return collapse(df, [pk], repeated.select("_rk0"), [])


def require_non_empty(df: DataFrame, message: str, exc: type[Exception] = ValueError) -> None:
    """O2: raise when ``df`` has no rows (``isEmpty`` reads at most one row)."""
    if df.isEmpty():
        raise exc(message)


def pk_collisions(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """G3 as a report: PKs carrying more than one distinct attribute profile."""
    others = [c for c in df.columns if c not in pk]
    return (
        df.groupBy(*pk)
        .agg(F.count_distinct(F.struct(*[F.col(c) for c in others])).alias("n_variants"))
        .filter(F.col("n_variants") > 1)
    )
