"""Deterministic keep-first deduplication (A7, A8, trap T9).

``dropDuplicates`` keeps an arbitrary row per key; a rerun on a different
cluster layout may keep another one. Here the survivor is the row with the
smallest ordering tuple, then the smallest full row.

Two phases: a hash aggregate over the key columns alone counts keys, and only
rows whose key repeats are ordered; rows of single keys bypass the sort and
the shuffle. The ordering keeps one row per key before the shuffle (Spark's
window group limit), so a hot key is collapsed map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from tidemark.operators.sizing import is_bounded
from tidemark.session import cut_lineage


def _unordered(dtype: DataType) -> bool:
    """Whether a type holds values that Spark cannot order."""
    if isinstance(dtype, MapType | VariantType):
        return True
    if isinstance(dtype, ArrayType):
        return _unordered(dtype.elementType)
    return isinstance(dtype, StructType) and any(_unordered(f.dataType) for f in dtype)


def comparable(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """The columns as values with an order; maps and variants as their JSON text."""
    return [F.to_json(F.struct(F.col(f"`{n}`"))) if _unordered(df.schema[n].dataType) else F.col(f"`{n}`") for n in names]


def _same_key(df: DataFrame, repeated: DataFrame, keys: Sequence[str]) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):  # null-safe, as the grouping is
        same = same & df[k].eqNullSafe(repeated[f"_rk{i}"])
    return same


def collapse(df: DataFrame, keys: Sequence[str], repeated: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One row per key, the first by ``order``, when ``repeated`` (``_rk0``, ...) names the keys with several rows.

    A bounded ``repeated`` is broadcast, and all other rows pass by; beyond
    the bound every row is ordered.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) if order else F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    if not is_bounded(repeated):
        return df.withColumn("_place", place).filter("_place = 1").drop("_place")
    if repeated.isEmpty():
        return df
    named = F.broadcast(repeated)
    same = _same_key(df, named, keys)
    several = df.join(named, same, "left_semi").withColumn("_place", place).filter("_place = 1").drop("_place")
    return df.join(named, same, "left_anti").unionByName(several)


def keep_first(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """One row per ``keys``: the one whose ``order`` tuple (then full row) is smallest.

    ``order`` entries are ascending; pass ``-F.col(x)`` for a descending
    numeric order. The full remaining row is the final tiebreak, so the pick
    is independent of partitioning. NULLs sort first. Columns of any type pass
    through, maps included. The repeated keys are counted and stored when
    this is called.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    repeated = cut_lineage(counted.select(*[F.col(k).alias(f"_rk{i}") for i, k in enumerate(keys)]))
    payload = [c for c in df.columns if c not in keys]
    ordering = [F.col(o) if isinstance(o, str) else o for o in order]
    return collapse(df, keys, repeated, [*ordering, *comparable(df, payload)])


def union_keep_existing(
    existing: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    tiebreak: Sequence[Column | str] = (),
    existing_unique: bool = False,
) -> DataFrame:
    """O5 + A8: union by name (missing columns NULL) and keep one row per key.

    A row already in ``existing`` beats any incoming row for the same key;
    within one side the smallest ``tiebreak`` tuple (then full row) wins. NULL
    keys equal each other on either path.

    ``existing_unique=True`` (the state a previous load produced is unique
    by construction): only the incoming side is deduplicated and anti-joined
    on the key, so the existing table's rows are never aggregated — only its
    key column is shuffled for the anti join.
    """
    if existing_unique:
        fresh = keep_first(incoming, keys, tiebreak)
        known = existing.select(*[F.col(k).alias(f"_have_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:  # null-safe, as the grouping of the other path is
            same = same & fresh[k].eqNullSafe(F.col(f"_have_{k}"))
        fresh = fresh.join(known, same, "left_anti")
        return existing.unionByName(fresh, allowMissingColumns=True)
    both = existing.withColumn("_src", F.lit(0)).unionByName(
        incoming.withColumn("_src", F.lit(1)), allowMissingColumns=True
    )
    cols = [c for c in both.columns if c != "_src"]
    picked = keep_first(both, keys, [F.col("_src"), *tiebreak])
    return picked.select(*cols)
