"""Registered schemas of the silver and gold tables.

DDL types follow Spark: unsized VARCHAR becomes STRING. PRIMARY KEY and NOT
NULL are not enforced by a parquet catalog, so the keys listed here are
enforced by the gates (:mod:`tidemark.operators.gates`) and NOT NULL by
:func:`tidemark.operators.dq.check_contract`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tidemark.sources.io import create_table


@dataclass(frozen=True)
class TableSpec:
    ddl: str
    primary_key: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    bucket_by: tuple[int, str] | None = None
    not_null: tuple[str, ...] = field(default=())

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)


# The warehouse tables and their layouts.
SILVER: dict[str, TableSpec] = {
    "silver_dim_team": TableSpec("id INT, title STRING", ("id",), not_null=("id", "title")),
    "silver_dim_player": TableSpec("id INT, player_name STRING", ("id",), not_null=("id", "player_name")),
    "silver_dim_injury": TableSpec(
        "player_id INT, category STRING, status STRING, valid_from DATE, valid_to DATE, is_current BOOLEAN",
        ("player_id", "category", "valid_from"),
        not_null=("player_id", "category", "status", "valid_from", "valid_to", "is_current"),
    ),
    "silver_fact_match": TableSpec(
        "match_id INT, team_h INT, team_a INT, season STRING, pts INT, xpts FLOAT",
        ("match_id",),
        partition_by=("season",),
        not_null=("match_id", "team_h", "team_a", "season", "pts", "xpts"),
    ),
    # Not partitioned by match_id (one folder per match); bucketed instead.
    "silver_fact_roster": TableSpec(
        "player_id INT, match_id INT", ("player_id", "match_id"), bucket_by=(100, "match_id"),
        not_null=("player_id", "match_id"),
    ),
    "silver_fact_shot": TableSpec(
        "id STRING, player_id INT, match_id INT, xg FLOAT", ("id",), bucket_by=(100, "match_id"),
        not_null=("id", "player_id", "match_id", "xg"),
    ),
    "silver_analytics_player_injury_summary": TableSpec(
        "player_id INT, valid_from DATE, valid_to DATE, injury_duration_days INT, cumulative_days_lost INT, "
        "availability_coefficient FLOAT, is_current BOOLEAN",
        ("player_id", "valid_from"),
        not_null=("player_id", "valid_from", "valid_to"),
    ),
    "silver_analytics_match_squad_health_deficit": TableSpec(
        "match_id INT, team_id INT, active_injured_count INT, total_squad_xg_drag FLOAT, total_squad_xga_drag FLOAT",
        ("match_id", "team_id"),
        bucket_by=(100, "match_id"),
        not_null=("match_id", "team_id", "active_injured_count"),
    ),
    "dim_teams": TableSpec("team_id STRING, team_name STRING, updated_at TIMESTAMP", ("team_id",)),
    "dim_players": TableSpec(
        "player_id STRING, player_name STRING, team_name STRING, team_id STRING, injury_status STRING, "
        "effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN",
        ("player_id", "effective_from"),
        partition_by=("is_current",),
    ),
    "fact_match_stats": TableSpec(
        "player_id STRING, team_id STRING, xg DOUBLE, actual_goals INT, snapshot_date DATE",
        (),
        partition_by=("snapshot_date",),
    ),
    "dq_metrics": TableSpec(
        "table_name STRING, dimension STRING, metric_name STRING, metric_value DOUBLE, unit STRING, "
        "check_timestamp TIMESTAMP, snapshot_date DATE",
        ("table_name", "metric_name", "snapshot_date"),
        partition_by=("snapshot_date",),
    ),
}

GOLD: dict[str, TableSpec] = {
    "gold_injury_summary": TableSpec("team_id INT, total_injured_players BIGINT", ("team_id",)),
    "gold_team_form": TableSpec(
        "team_id INT, match_id INT, xg DOUBLE, date STRING, rolling_avg_xg DOUBLE", ("team_id", "match_id")
    ),
    "gold_player_stats": TableSpec(
        "player_id INT, total_shots BIGINT, total_expected_goals DOUBLE, avg_shot_quality DOUBLE", ("player_id",)
    ),
}


def create_tables(spark: SparkSession, namespace: str | None = None, specs: dict[str, TableSpec] | None = None) -> None:
    """S5 + S6: idempotently create every registered table (parquet catalog)."""
    specs = specs if specs is not None else {**SILVER, **GOLD}
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")
    for name, spec in specs.items():
        full = f"{namespace}.{name}" if namespace else name
        create_table(spark, full, spec.schema, spec.partition_by, spec.bucket_by)
