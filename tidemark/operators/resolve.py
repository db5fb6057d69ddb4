"""Entity resolution against a governance mapping.

Three policies share one plan: the unresolved set is a distinct left-anti
join of input keys against the mapping (NULL keys never match, trap T21),
the resolved set an inner equi join.

* ``fail``       — raise :class:`UnresolvedEntityError` naming the smallest culprit;
* ``warn``       — return the inner join; the dropped-row count is observed
                   during the caller's own action (no extra pass);
* ``quarantine`` — return ``(resolved, unresolved_rows)``.

The mapping is broadcast only after a bounded row count proves it small;
otherwise AQE picks the join from runtime sizes.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.errors import MSG_UNRESOLVED, IntraBatchDuplicateError, UnresolvedEntityError
from tidemark.functions.exprs import hash_key
from tidemark.operators.gates import first_duplicate
from tidemark.operators.sizing import broadcast_if_bounded
from tidemark.session import cut_lineage
from tidemark.sources.io import read_source

log = logging.getLogger(__name__)


@dataclass
class ResolveReport:
    """Row counts observed while the caller's action runs (R3 'governance gap')."""

    raw: Observation
    resolved: Observation

    def gap(self) -> int:
        raw = self.raw.get.get("n", 0)
        res = self.resolved.get.get("n", 0)
        return int(raw) - int(res)


def unresolved_keys(input_df: DataFrame, lookup_df: DataFrame, input_key: str, lookup_key: str):
    keys = input_df.select(F.col(input_key).alias("_k")).distinct()
    known = lookup_df.select(F.col(lookup_key).alias("_lk")).distinct()
    return keys.join(known, F.col("_k") == F.col("_lk"), "left_anti")


def resolve_entities(
    input_df: DataFrame,
    lookup_df: DataFrame,
    input_key: str,
    lookup_key: str,
    policy: str = "fail",
    check_lookup_unique: bool = True,
    broadcast_lookup: bool = False,
):
    """Map raw names to golden ids; the raw input key is dropped."""
    if policy not in ("fail", "warn", "quarantine"):
        raise ValueError(f"unknown policy {policy!r}")
    if check_lookup_unique:
        dup = first_duplicate(lookup_df, [lookup_key])
        if dup is not None:
            raise IntraBatchDuplicateError(
                f"Mapping key {lookup_key}={dup[lookup_key]!r} maps to several ids"
            )
    lookup = broadcast_if_bounded(lookup_df) if broadcast_lookup else lookup_df
    if policy == "fail":
        culprit = (
            unresolved_keys(input_df, lookup_df, input_key, lookup_key)
            .orderBy(F.col("_k").asc_nulls_first())
            .limit(1)
            .collect()
        )
        if culprit:
            raise UnresolvedEntityError(f"{MSG_UNRESOLVED}: {culprit[0]['_k']}")
    cond = input_df[input_key] == lookup[lookup_key]
    resolved = input_df.join(lookup, cond, "inner").drop(input_df[input_key])
    if policy == "quarantine":
        unresolved = input_df.join(lookup.select(lookup_key), cond, "left_anti")
        return resolved, unresolved
    if policy == "warn":
        raw_obs, res_obs = Observation("raw"), Observation("resolved")
        observed_in = input_df.observe(raw_obs, F.count(F.lit(1)).alias("n"))
        out = observed_in.join(lookup, observed_in[input_key] == lookup[lookup_key], "inner").drop(
            observed_in[input_key]
        )
        out = out.observe(res_obs, F.count(F.lit(1)).alias("n"))
        return out, ResolveReport(raw_obs, res_obs)
    return resolved


def resolve_team_entities(input_df: DataFrame, lookup_df: DataFrame, policy: str = "fail"):
    return resolve_entities(input_df, lookup_df, "team_name", "raw_name", policy)


def resolve_player_entities(input_df: DataFrame, lookup_df: DataFrame, policy: str = "fail"):
    return resolve_entities(input_df, lookup_df, "player_name", "raw_player_name", policy)


def resolve_player_identities(raw_df: DataFrame, mapping_df: DataFrame) -> DataFrame:
    """R2: every raw name must map to a player id; returns (player_id, raw_name)."""
    resolved = raw_df.join(mapping_df, on="raw_name", how="left")
    if not resolved.filter(F.col("player_id").isNull()).isEmpty():
        raise UnresolvedEntityError(f"{MSG_UNRESOLVED}: raw names without a mapping entry")
    return resolved.select("player_id", "raw_name")


def resolve_source(
    spark: SparkSession,
    bronze_path: str,
    mapping_path: str,
    source_name_col: str,
    mapping_name_col: str = "source_name",
    team_col: str = "team_name",
):
    """Read a bronze feed and its mapping, inner-join (policy ``warn``).

    Adds ``player_id = md5(trim(mapped name))`` and ``team_id =
    md5(trim(team))`` — both trimmed, so the keys agree with the team
    dimension's (trap T11). Returns ``(df, report)``; ``report.gap()`` after
    an action gives the number of dropped rows.
    """
    raw = read_source(spark, bronze_path)
    mapping = read_source(spark, mapping_path)
    out, report = resolve_entities(
        raw,
        mapping,
        source_name_col,
        mapping_name_col,
        policy="warn",
        broadcast_lookup=True,
    )
    out = out.withColumn("player_id", hash_key(mapping_name_col)).withColumn(
        "team_id", hash_key(team_col)
    )
    return out, report


def resolve_published(
    spark: SparkSession,
    bronze_path: str,
    mapping_path: str,
    source_name_col: str,
    mapping_name_col: str = "source_name",
    team_col: str = "team_name",
) -> tuple[DataFrame, DataFrame]:
    """R3 written, then audited (A9): ``(resolved, counts)``.

    The rows are written once to the shared folder while both counts ride on
    the write; ``counts`` has one row: ``raw_rows``, ``resolved_rows`` and
    ``left_out``, the rows without a mapping entry.
    """
    out, report = resolve_source(spark, bronze_path, mapping_path, source_name_col, mapping_name_col, team_col)
    stored = cut_lineage(out)
    raw, resolved = int(report.raw.get.get("n", 0)), int(report.resolved.get.get("n", 0))
    counts = spark.createDataFrame([(raw, resolved, raw - resolved)], "raw_rows long, resolved_rows long, left_out long")
    return stored, counts


def log_gap(report: ResolveReport, source: str) -> int:
    gap = report.gap()
    if gap > 0:
        log.warning("%s: %d rows have no mapping entry and were left out", source, gap)
    return gap
