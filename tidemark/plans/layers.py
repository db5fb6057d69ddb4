"""Layer runners: bronze -> silver -> data-quality gate -> gold.

One Spark application runs every layer; tables hand off through a
warehouse folder on shared storage. Dimension states are published as
immutable versions (``<warehouse>/<table>/v=<n>``), facts and metrics are
written with dynamic partition overwrite, so re-running a day is safe.
"""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean_whitespace
from tidemark.operators import dq
from tidemark.operators.loads import upsert_dim_teams, write_fact_match_stats
from tidemark.operators.resolve import log_gap, resolve_source
from tidemark.operators.scd2 import upsert_dim_players_scd2
from tidemark.plans.gold import register_gold_views
from tidemark.sources.io import publish_version, read_latest, read_source, write_partition, write_partitioned

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Paths:
    teams_bronze: str  # league teams feed: ``title``
    injuries_bronze: str  # extracted injury grid: player_name, team, reason, ...
    players_bronze: str  # extracted league players: name, team, xg, goals
    mapping: str  # governance mapping: source_name -> verified name
    warehouse: str  # shared output folder

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


def run_silver(spark: SparkSession, paths: Paths, processing_ts: _dt.datetime) -> dict[str, DataFrame]:
    """Team dimension (SCD1) then player dimension (SCD2) as new versions."""
    teams_prev = read_latest(spark, paths.table("dim_teams"))
    teams = upsert_dim_teams(teams_prev, read_source(spark, paths.teams_bronze), "title", processing_ts)
    publish_version(teams, paths.table("dim_teams"))

    resolved, report = resolve_source(
        spark, paths.injuries_bronze, paths.mapping, "player_name", team_col="team"
    )
    incoming = resolved.select(
        "player_id",
        F.col("source_name").alias("player_name"),
        clean_whitespace("team").alias("team_name"),
        "team_id",
        F.col("reason").alias("injury_status"),
    )
    players_prev = read_latest(spark, paths.table("dim_players"))
    players = upsert_dim_players_scd2(
        players_prev, incoming, processing_ts, carried=("player_name", "team_id")
    )
    publish_version(players, paths.table("dim_players"), partition_by=["is_current"])
    log_gap(report, paths.injuries_bronze)
    return {
        "dim_teams": read_latest(spark, paths.table("dim_teams")),
        "dim_players": read_latest(spark, paths.table("dim_players")),
    }


def run_gold(
    spark: SparkSession,
    paths: Paths,
    snapshot_date: _dt.date,
    check_ts: _dt.datetime,
    dq_threshold: float = 0.95,
) -> dict[str, DataFrame]:
    """E2 + E3 tail: fact snapshot staged, DQ metrics and gate, then facts and gold views published.

    The gate measures the staged snapshot; facts that fail it never reach
    the live table, which keeps what an earlier run has published.
    """
    resolved, report = resolve_source(spark, paths.players_bronze, paths.mapping, "name", team_col="team")
    write_fact_match_stats(resolved, paths.table("staging/fact_match_stats"), snapshot_date)
    log_gap(report, paths.players_bronze)

    held = spark.read.parquet(paths.table("staging/fact_match_stats"))
    staged = held.filter(F.col("snapshot_date") == F.lit(snapshot_date))
    players = read_latest(spark, paths.table("dim_players"))
    teams = read_latest(spark, paths.table("dim_teams"))
    kw = dict(snapshot_date=snapshot_date, check_timestamp=check_ts)
    metrics = (
        dq.measure_table(players, "dim_players", not_null=["player_id", "effective_from"], **kw)
        .unionByName(dq.measure_table(staged, "fact_match_stats", not_null=["xg", "actual_goals"], **kw))
        .unionByName(dq.orphan_share(staged, "team_id", teams, "team_id", "fact_match_stats", **kw))
    )
    write_partitioned(metrics, paths.table("dq_metrics"), ["snapshot_date"])
    stored = spark.read.parquet(paths.table("dq_metrics"))
    dq.dq_gate(stored.filter(F.col("snapshot_date") == F.lit(snapshot_date)), dq_threshold)
    write_partition(
        staged.drop("snapshot_date"), paths.table("fact_match_stats"), "snapshot_date", snapshot_date.isoformat()
    )
    facts = spark.read.parquet(paths.table("fact_match_stats"))

    silver = {"fact_match_stats": facts, "dim_players": players, "dim_teams": teams, "dq_metrics": stored}
    register_gold_views(
        spark,
        silver,
        ["gold_team_health_performance", "gold_historical_player_impact", "gold_data_governance_report"],
    )
    return silver


def run_all(
    spark: SparkSession,
    paths: Paths,
    processing_ts: _dt.datetime,
    dq_threshold: float = 0.95,
) -> dict[str, DataFrame]:
    """Bronze -> silver -> DQ gate -> gold for one processing day."""
    run_silver(spark, paths, processing_ts)
    return run_gold(spark, paths, processing_ts.date(), processing_ts, dq_threshold)


def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files tidemark.zip tidemark/plans/layers.py --warehouse ... --processing-ts ...``."""
    import argparse

    from tidemark.session import build_session

    p = argparse.ArgumentParser(description="Run bronze -> silver -> DQ gate -> gold for one day")
    p.add_argument("--teams", required=True)
    p.add_argument("--injuries", required=True)
    p.add_argument("--players", required=True)
    p.add_argument("--mapping", required=True)
    p.add_argument("--warehouse", required=True)
    p.add_argument("--processing-ts", required=True, help="e.g. 2024-02-01T06:00:00")
    p.add_argument("--dq-threshold", type=float, default=0.95)
    p.add_argument("--layer", choices=["silver", "gold", "all"], default="all")
    a = p.parse_args(argv)
    ts = _dt.datetime.fromisoformat(a.processing_ts)
    paths = Paths(a.teams, a.injuries, a.players, a.mapping, a.warehouse)
    spark = build_session(app_name=f"tidemark-{a.layer}")
    if a.layer in ("silver", "all"):
        run_silver(spark, paths, ts)
    if a.layer in ("gold", "all"):
        run_gold(spark, paths, ts.date(), ts, a.dq_threshold)


if __name__ == "__main__":
    main()
