"""Ordered-frame metrics that stay balanced when one key is huge.

A ``Window.partitionBy(key)`` sends every row of a key to one task. For most
keys that is fine; a key holding a third of the table would serialise the job.
:func:`rolling_avg` and :func:`running_sum` therefore run a segmented prefix
scan once a table has more than ``range_rows`` rows:

1. rows are dealt into ranges of ``(key, order)`` whose bounds are quantiles of
   a sample. A bound inside a key splits that key there, wherever its rows lie,
   so a key with a third of the rows on one date is split like any other (by
   the next order column). Keys without a bound stay in one range;
2. one window per ``(key, range)``;
3. a carry per range of a split key - the last ``|lo|`` values before it, or
   the total of all before it - completes the first rows of the range, or all.

Bounds and carries are counted in ranges, not rows: a few per ``range_rows``
rows. They are collected, and travel as one small broadcast table, so the
query itself reads its source once and shuffles it once. A source that has to
be computed (joins, aggregates, windows) is stored before it is sampled.

Up to ``range_rows`` rows the plain window runs. Both paths give the same
answer, NULL keys, NULL order values and NULL values included. Frames are
``ROWS BETWEEN lo AND hi`` with ``lo < 0`` and ``hi <= 0`` - look-back frames,
which is what the baseline and form metrics use.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, DecimalType, FractionalType, IntegerType, StructField, StructType

from tidemark.session import cut_lineage

# Rows of a range; a table of no more rows is not split at all.
RANGE_ROWS = 5_000_000
# Sampled rows per range: the bounds lie within some tenths of a range of the true quantiles.
SAMPLED_PER_RANGE = 30
# Bounds of one key are searched in two steps: among every STRIDE-th, then among STRIDE.
STRIDE = 64


@dataclass
class Ranges:
    """Bounds of split keys: rows of (key, [order values of the first row of each further range])."""

    key: StructField
    order: StructType
    bounds: list[tuple]


def _fits(df: DataFrame, range_rows: int) -> bool:
    """Whether the plain window will do; looks at ``range_rows + 1`` rows at most."""
    return df.select(F.lit(1)).limit(range_rows + 1).count() <= range_rows


def _table(df: DataFrame) -> DataFrame:
    """``df`` to be read several times: stored first if it has to be computed, a mere scan as it is."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return cut_lineage(df) if re.search(r"\b(Aggregate|Join|Window|Generate|Distinct|Expand)\b", plan) else df


def ranges_of(df: DataFrame, key: str, order: Sequence[str], range_rows: int) -> Ranges | None:
    """The keys to split and where, or ``None`` when the plain window will do.

    A larger table is counted, and its key and order columns are sampled. What
    is collected is one row per bound.
    """
    return None if _fits(df, range_rows) else _ranges(df, key, order, range_rows)


def _ranges(df: DataFrame, key: str, order: Sequence[str], range_rows: int) -> Ranges:
    total = df.count()
    wanted = -(-total // range_rows)
    spec = df.select(key, *order).schema
    picked = df.select(F.col(key).alias("_k"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)])
    share = min(1.0, SAMPLED_PER_RANGE * wanted / total)
    names = [f"_o{i}" for i in range(len(order))]
    # One task ranks the sample, which holds some SAMPLED_PER_RANGE rows per range.
    place = F.row_number().over(Window.orderBy("_k", *names)) % max(1, int(share * range_rows))
    marks = picked.sample(False, share, seed=17).withColumn("_p", place).filter("_p = 0").groupBy("_k")
    found = marks.agg(F.array_sort(F.collect_set(F.struct(*names))).alias("_bounds")).collect()
    bounds = [(r["_k"], [tuple(b) for b in r["_bounds"]]) for r in found]
    return Ranges(spec[0], StructType([StructField(n, f.dataType) for n, f in zip(names, spec.fields[1:])]), bounds)


def _dealt(df: DataFrame, ranges: Ranges, order: Sequence[str], carry: list | None = None, kind: DataType | None = None) -> DataFrame:
    """``df`` with ``_s``, the number of a row's key among the split ones, ``_b``, the
    place of its range within the key, and ``_in``, that range's entry of ``carry``."""
    rows = []
    for s, (k, bounds) in enumerate(ranges.bounds):
        rows.append((s, k, bounds, bounds[::STRIDE], carry[s] if carry is not None else None))
    table = df.sparkSession.createDataFrame(
        rows,
        StructType(
            [
                StructField("_s", IntegerType()),
                StructField("_sk", ranges.key.dataType),
                StructField("_bounds", ArrayType(ranges.order)),
                StructField("_coarse", ArrayType(ranges.order)),
                StructField("_carry", ArrayType(kind or ranges.order)),
            ]
        ),
    )
    x = df.join(F.broadcast(table), F.col(ranges.key.name).eqNullSafe(F.col("_sk")), "left")
    here = F.struct(*[F.col(o).alias(f.name) for o, f in zip(order, ranges.order)])
    steps = F.size(F.filter("_coarse", lambda bound: bound <= here))
    stretch = F.slice("_bounds", F.greatest(F.lit(1), (steps - 1) * STRIDE + 1), F.lit(STRIDE))
    within = F.size(F.filter(stretch, lambda bound: bound <= here))
    place = F.when(steps > 0, (steps - 1) * STRIDE + within).otherwise(F.lit(0))
    x = x.withColumn("_b", F.when(F.col("_bounds").isNull(), F.lit(0)).otherwise(place))
    if carry is not None:
        x = x.withColumn("_in", F.get("_carry", F.col("_b")))
    return x.drop("_sk", "_bounds", "_coarse", "_carry")


def _frame_value(v: Column, scale: int | None):
    if scale is None:
        return v.cast("double")
    return v.cast(f"decimal(18,{scale})")


def rolling_avg(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    lo: int,
    hi: int,
    out: str,
    scale: int | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``AVG(value) OVER (PARTITION BY key ORDER BY order ROWS BETWEEN lo AND hi)``.

    ``scale``: sum as DECIMAL with that many decimals (exact, rerun-stable).
    ``range_rows``: rows per range of the prefix scan.
    """
    if not (lo < 0 and hi <= 0 and lo <= hi):
        raise ValueError("look-back frames only: lo < 0, lo <= hi <= 0")
    if _fits(df, range_rows):
        return _plain_rolling(df, key, order, value, lo, hi, out, scale)
    df = _table(df)
    ranges = _ranges(df, key, order, range_rows)
    return _scanned_rolling(df, ranges, key, order, value, lo, hi, out, scale)


def _avg_from(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n)


def _plain_rolling(df, key, order, value, lo, hi, out, scale):
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(lo, hi)
    v = _frame_value(F.col(value), scale)
    return df.withColumn(out, _avg_from(F.sum(v).over(w), F.count(v).over(w)))


def _split_rows(df: DataFrame, ranges: Ranges, key: str) -> DataFrame:
    """The rows of split keys only: no other range has one before it."""
    keys = df.sparkSession.createDataFrame([(k,) for k, _ in ranges.bounds], StructType([StructField("_sk", ranges.key.dataType)]))
    return df.join(F.broadcast(keys), df[key].eqNullSafe(F.col("_sk")), "left_semi")


def _last_values(df: DataFrame, ranges: Ranges, key: str, order: Sequence[str], depth: int) -> list:
    """Per split key and range the last ``depth`` values before it, at most ``depth`` per bound."""
    x = _dealt(_split_rows(df.select(key, *order, "_v"), ranges, key), ranges, order)
    # Spark keeps the last ``depth`` rows per (key, range) before it shuffles them.
    back = Window.partitionBy(key, "_b").orderBy(*[F.col(o).desc() for o in order])
    last = x.withColumn("_rn", F.row_number().over(back)).filter(F.col("_rn") <= depth)
    tails: dict = {}
    for r in last.select("_s", "_b", "_rn", "_v").collect():
        tails.setdefault((r["_s"], r["_b"]), []).append((-r["_rn"], r["_v"]))
    carry = []
    for s, (_, bounds) in enumerate(ranges.bounds):
        held: list = []
        carry.append([])
        for b in range(len(bounds) + 1):
            carry[s].append(held)
            held = (held + [v for _, v in sorted(tails.get((s, b), []), key=lambda t: t[0])])[-depth:]
    return carry


def _scanned_rolling(df, ranges, key, order, value, lo, hi, out, scale):
    depth = -lo  # rows of look-back needed at the start of a range
    cols = df.columns
    df = df.withColumn("_v", _frame_value(F.col(value), scale))
    kind = df.schema["_v"].dataType
    carry = _last_values(df, ranges, key, order, depth)
    x = _dealt(df, ranges, order, carry, ArrayType(kind))
    wo = Window.partitionBy(key, "_b").orderBy(*order)
    boxed = F.struct("_v")  # collect_list drops bare NULLs
    x = x.withColumn("_rn", F.row_number().over(wo))
    frame = wo.rowsBetween(lo, hi)
    x = x.withColumn("_fs", F.sum("_v").over(frame)).withColumn("_fn", F.count("_v").over(frame))
    # The frame of row ``rn`` reaches from carried place held + rn + lo to held + min(0, rn + hi).
    held = F.coalesce(F.size("_in"), F.lit(0))
    first = F.greatest(F.lit(1), held + F.col("_rn") + lo)
    last = held + F.least(F.lit(0), F.col("_rn") + hi)
    borrowed = F.when((held > 0) & (last >= first), F.slice("_in", first, last - first + 1))
    borrowed = F.filter(F.coalesce(borrowed, F.array().cast(ArrayType(kind))), lambda v: v.isNotNull())
    if scale is None:
        # Floating sums depend on their order: add the whole frame from its first row on.
        x = x.withColumn("_own", F.collect_list(F.when(F.col("_rn") <= 2 * depth, boxed)).over(frame))
        own = F.filter(F.transform("_own", lambda e: e["_v"]), lambda v: v.isNotNull())
        whole = F.concat(borrowed, own)
        total, n = F.aggregate(whole, F.lit(0.0), lambda acc, v: acc + v), F.size(whole)
    else:
        wide = f"decimal(38,{scale})"
        total = F.aggregate(borrowed, F.coalesce(F.col("_fs"), F.lit(0)).cast(wide), lambda acc, v: (acc + v).cast(wide))
        n = F.size(borrowed) + F.col("_fn")
    at_start = (F.col("_rn") <= depth) & (held > 0)
    result = F.when(at_start, _avg_from(total, n)).otherwise(_avg_from(F.col("_fs"), F.col("_fn")))
    return x.withColumn(out, result).select(*cols, out)


def running_sum(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    out: str,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``SUM(value) OVER (PARTITION BY key ORDER BY order ROWS UNBOUNDED PRECEDING)``.

    Each row of a range adds the total of the earlier ranges of its key. A
    table that has to be split needs an integer or decimal ``value``: floating
    sums depend on their order, and the answer must not depend on the split.
    """
    if _fits(df, range_rows):
        run = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumn(out, F.sum(value).over(run))
    if isinstance(df.schema[value].dataType, FractionalType) and not isinstance(df.schema[value].dataType, DecimalType):
        raise ValueError(f"a split running sum needs an integer or decimal value, not {df.schema[value].dataType}")
    cols = df.columns
    df = _table(df)
    ranges = _ranges(df, key, order, range_rows)
    kind = df.select(F.sum(value)).schema[0].dataType
    x = _dealt(_split_rows(df.select(key, *order, value), ranges, key), ranges, order)
    totals = {(r["_s"], r["_b"]): r["_tot"] for r in x.groupBy("_s", "_b").agg(F.sum(value).alias("_tot")).collect()}
    carry: list = []
    for s, (_, bounds) in enumerate(ranges.bounds):
        so_far = None
        carry.append([])
        for b in range(len(bounds) + 1):
            carry[s].append(so_far)
            add = totals.get((s, b))
            so_far = add if so_far is None else so_far if add is None else so_far + add
    y = _dealt(df, ranges, order, carry, kind)
    run = Window.partitionBy(key, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y = y.withColumn("_local", F.sum(value).over(run))
    total = F.coalesce(F.col("_local") + F.col("_in"), F.col("_local"), F.col("_in")).cast(kind)
    return y.withColumn(out, total).select(*cols, out)
