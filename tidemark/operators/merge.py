"""Keyed merges without an ACID table format.

A merge is computed as a new table state from (target, source); the sink
(:func:`tidemark.sources.io.publish_version`) writes it as the next version,
so the job never reads and overwrites the same files.

* full replace (``INSERT OR REPLACE`` / ``MERGE ... UPDATE SET *``):
  ``target LEFT ANTI source-keys  UNION  source`` — a small source is the
  broadcast build side, so the target is read once and not shuffled;
* column-subset / conditional update: a left join of the target with the
  (broadcastable) source plus a key-only anti join for inserts, with
  null-safe change detection (trap T6).

Source keys are gated first, in one pass: unique (trap T10), as a merge source
with two rows per key has no defined result, and not NULL, as a NULL key would
be inserted again on every run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.errors import IntraBatchDuplicateError, NullKeyError
from tidemark.operators.sizing import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, KEY_COLUMN_BYTES, row_bytes, rows_within


def _source_keys(source: DataFrame, keys: Sequence[str], check_unique: bool):
    """One pass over the source: the NULL-key gate, the uniqueness gate (T10), its key count.

    Returns ``(distinct_keys, n_keys)``; raises ``NullKeyError`` when a key
    column is NULL, ``IntraBatchDuplicateError`` when ``check_unique`` and a
    key occurs twice.
    """
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    is_null = F.lit(False)
    for k in keys:
        is_null = is_null | F.col(k).isNull()
    stats = per_key.agg(
        F.max("_n").alias("most"), F.count(F.lit(1)).alias("nkeys"), F.count_if(is_null).alias("nulls")
    ).first()
    if stats["nulls"]:
        raise NullKeyError(f"Merge source has a NULL in its key {list(keys)}")
    if check_unique and stats["most"] is not None and stats["most"] > 1:
        raise IntraBatchDuplicateError(f"Merge source repeats a key of {list(keys)}")
    return per_key.select(*keys), int(stats["nkeys"])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    check_source_unique: bool = True,
) -> DataFrame:
    """Matched keys take the source row, others are inserted; rerun-stable."""
    cols = target.columns
    src = source.select(*cols)
    src_keys, n_keys = _source_keys(src, keys, check_source_unique)
    if n_keys <= min(BROADCAST_MAX_ROWS, rows_within(KEY_COLUMN_BYTES * len(keys))):
        src_keys = F.broadcast(src_keys)
    kept = target.join(src_keys, on=list(keys), how="left_anti")
    return kept.unionByName(src)


def merge_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    insert: bool = True,
    only_if_changed: Sequence[str] | None = None,
    check_source_unique: bool = True,
) -> DataFrame:
    """``WHEN MATCHED [AND changed] THEN UPDATE SET update_cols [WHEN NOT MATCHED THEN INSERT]``.

    ``only_if_changed`` names the columns whose null-safe difference makes
    a matched row eligible for update; columns not in ``update_cols`` keep
    the target value.

    Plan: ``target LEFT JOIN source`` applies the updates (a small source is
    the broadcast build side, the target is not shuffled), and inserts are
    ``source LEFT ANTI target`` over the target's key columns only — never
    a full outer join that would shuffle every target row.
    """
    _, n_keys = _source_keys(source, keys, check_source_unique)
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in source.columns], F.lit(True).alias("_s"))
    # Whole source rows (one per key once gated): bounded by their measured bytes.
    if check_source_unique and n_keys <= BROADCAST_MAX_ROWS and row_bytes(source) <= BROADCAST_MAX_BYTES:
        s = F.broadcast(s)
    cond = None
    for k in keys:
        e = target[k] == F.col(f"s_{k}")
        cond = e if cond is None else cond & e
    j = target.join(s, cond, "left")
    matched = F.col("_s").isNotNull()
    if only_if_changed:
        changed = None
        for c in only_if_changed:
            d = ~target[c].eqNullSafe(F.col(f"s_{c}"))
            changed = d if changed is None else changed | d
        do_update = matched & changed
    else:
        do_update = matched
    cols = []
    for c in target.columns:
        if c in update_cols and c in source.columns and c not in keys:
            cols.append(F.when(do_update, F.col(f"s_{c}")).otherwise(target[c]).alias(c))
        else:
            cols.append(target[c].alias(c))
    updated = j.select(*cols)
    if not insert:
        return updated
    new_rows = source.join(target.select(*keys), list(keys), "left_anti")
    fill = [F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType).alias(c) for c in target.columns]
    return updated.unionByName(new_rows.select(*fill))
