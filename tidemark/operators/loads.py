"""Idempotent silver loads.

All loads are ``f(existing_state, batch) -> new_state`` and a second run
with the same batch returns the same state. Deduplication keeps the
existing row (trap T9); new dimension members get ids after the current
maximum, in a deterministic order, without a single-task global sort (T8).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.errors import MSG_UNRESOLVED, NullKeyError, UnresolvedEntityError
from tidemark.functions.exprs import hash_key
from tidemark.operators.dedup import union_keep_existing
from tidemark.operators.merge import merge_update
from tidemark.sources.io import write_partition

# Hex digits of the md5 prefix used to number new keys in parallel (4096 buckets).
ID_BUCKET_HEX = 3


def assign_ids(new_keys: DataFrame, key: str, id_col: str, start: int) -> DataFrame:
    """number distinct new keys ``start+1, start+2, ...`` in ``md5(key), key`` order.

    Rows are numbered inside 4096 md5-prefix buckets in parallel; each
    bucket's offset is a prefix sum over at most 4096 bucket sizes (a
    fixed, tiny table that is broadcast). The result equals
    ``start + row_number() OVER (ORDER BY md5(key), key)``.
    """
    h = F.md5(F.col(key).cast("string"))
    x = new_keys.select(key).withColumn("_h", h).withColumn("_bk", F.substring("_h", 1, ID_BUCKET_HEX))
    x = x.withColumn("_rn", F.row_number().over(Window.partitionBy("_bk").orderBy("_h", key)))
    sizes = x.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"))
    prefix = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(prefix), F.lit(0))).select("_bk", "_off")
    return x.join(F.broadcast(offsets), "_bk").select(
        key, (F.lit(start).cast("long") + F.col("_off") + F.col("_rn")).alias(id_col)
    )


def _max_id(df: DataFrame, id_col: str) -> int:
    row = df.agg(F.max(id_col)).first()
    return int(row[0]) if row and row[0] is not None else 0


def load_new_members(initial: DataFrame, batch: DataFrame, key: str, id_col: str) -> DataFrame:
    """L2 core: existing members keep their id; unseen keys are numbered after the max.

    A NULL natural key raises ``NullKeyError``: no id could be found again for it.
    """
    if not batch.filter(F.col(key).isNull()).isEmpty():
        raise NullKeyError(f"NULL natural key {key!r} in the batch")
    if id_col in batch.columns:
        return union_keep_existing(initial, batch, [key])
    new = batch.select(key).distinct().join(initial.select(key), key, "left_anti")
    numbered = assign_ids(new, key, id_col, _max_id(initial, id_col))
    return initial.unionByName(numbered, allowMissingColumns=True)


def load_silver_teams(initial: DataFrame, batch: DataFrame) -> DataFrame:
    """L2: teams keyed by ``raw_name`` with ``team_id``."""
    return load_new_members(initial, batch, "raw_name", "team_id")


def load_silver_players(initial: DataFrame, batch: DataFrame) -> DataFrame:
    """L2: players keyed by ``raw_name`` with ``player_id``."""
    return load_new_members(initial, batch, "raw_name", "player_id")


def load_silver_matches(
    initial: DataFrame,
    batch: DataFrame,
    teams: DataFrame | None = None,
    initial_unique: bool = False,
    policy: str = "fail",
):
    """L1 + F15: a batch carrying team *names* is aligned to ids through the
    team dimension (``raw_name -> team_id``), then deduplicated by match_id.

    Names the dimension lacks (NULL among them) raise
    ``UnresolvedEntityError`` under ``policy="fail"``; under
    ``"quarantine"`` their matches stay out of the load and are returned
    beside it: ``(state, quarantined)``.
    """
    if policy not in ("fail", "quarantine"):
        raise ValueError(f"unknown policy {policy!r}")
    quarantined = None
    if "home_team" in batch.columns:
        if teams is None:
            raise ValueError("a batch with team names needs the team dimension")
        t = teams.select("raw_name", "team_id")
        home = t.select(F.col("raw_name").alias("home_team"), F.col("team_id").alias("home_id"))
        away = t.select(F.col("raw_name").alias("away_team"), F.col("team_id").alias("away_id"))
        aligned = batch.join(home, "home_team", "left").join(away, "away_team", "left")
        unknown = F.col("home_id").isNull() | F.col("away_id").isNull()
        if policy == "fail":
            lost = aligned.filter(unknown).select(
                F.when(F.col("home_id").isNull(), F.col("home_team")).otherwise(F.col("away_team")).alias("name")
            )
            culprit = lost.limit(1).collect()
            if culprit:
                raise UnresolvedEntityError(f"{MSG_UNRESOLVED}: {culprit[0]['name']}")
        else:
            quarantined = aligned.filter(unknown).select(*batch.columns)
            aligned = aligned.filter(~unknown)
        batch = aligned.drop("home_team", "away_team")
    state = union_keep_existing(initial, batch, ["match_id"], existing_unique=initial_unique)
    if policy == "quarantine":
        return state, batch.limit(0) if quarantined is None else quarantined
    return state


def load_silver_shots(initial: DataFrame, batch: DataFrame, initial_unique: bool = False) -> DataFrame:
    """L3: shots deduplicated by ``shot_id``.

    ``initial_unique``: the table was produced by this load (unique by
    construction), so only the batch is deduplicated and anti-joined.
    """
    return union_keep_existing(initial, batch, ["shot_id"], existing_unique=initial_unique)


def load_silver_rosters(initial: DataFrame, batch: DataFrame, initial_unique: bool = False) -> DataFrame:
    """L4: rosters deduplicated by (team_id, player_id, season)."""
    return union_keep_existing(
        initial, batch, ["team_id", "player_id", "season"], existing_unique=initial_unique
    )


def upsert_dim_teams(
    target: DataFrame | None, raw: DataFrame, title_col: str, processing_ts: _dt.datetime
) -> DataFrame:
    """SCD1 team dimension ``(team_id = md5(trim(title)), team_name, updated_at)``."""
    source = raw.select(
        hash_key(title_col).alias("team_id"),
        F.trim(F.col(title_col)).alias("team_name"),
        F.lit(processing_ts).alias("updated_at"),
    ).distinct()
    if target is None:
        return source
    return merge_update(target, source, ["team_id"], ["team_name", "updated_at"])


def write_fact_match_stats(
    resolved: DataFrame,
    path: str,
    snapshot_date: _dt.date,
    xg_col: str = "xg",
    goals_col: str = "goals",
    keys: Sequence[str] = ("player_id", "team_id"),
) -> DataFrame:
    """Cast and stamp the fact, then replace that snapshot's partition.

    A rerun of the same day replaces its partition instead of appending a
    copy (trap T13), also when the rerun has no rows.
    """
    fact = resolved.select(
        *keys,
        F.col(xg_col).try_cast("double").alias("xg"),
        F.col(goals_col).try_cast("int").alias("actual_goals"),
        F.lit(snapshot_date).alias("snapshot_date"),
    )
    write_partition(fact.drop("snapshot_date"), path, "snapshot_date", snapshot_date.isoformat())
    return fact
