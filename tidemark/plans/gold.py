"""Gold layer: serving views and upserted gold tables.

Each gold view is a DataFrame builder over silver tables;
:func:`register_gold_views` publishes the builders' plans as SQL views.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join
from tidemark.operators.merge import upsert
from tidemark.operators.windows import rolling_avg
from tidemark.sources.io import register_views

# Data-governance status labels and thresholds.
STATUS_CRITICAL = "🔴 CRITICAL"
STATUS_WARNING = "🟡 WARNING"
STATUS_HEALTHY = "🟢 HEALTHY"
CRITICAL_BELOW = 0.95
WARNING_BELOW = 0.99

def register_gold_views(
    spark: SparkSession, silver: Mapping[str, DataFrame], views: Sequence[str] | None = None
) -> None:
    """Expose the silver tables, then (re)create the gold views over them.

    Each view is the plan of its builder below registered under the view's
    name, so SQL users and DataFrame users read the same Catalyst plan.
    Views whose inputs are missing from ``silver`` are skipped unless named.
    """
    register_views(spark, silver)
    names = list(views) if views is not None else [
        n for n, (inputs, _) in GOLD_VIEWS.items() if all(i in silver for i in inputs)
    ]
    for name in names:
        inputs, build = GOLD_VIEWS[name]
        build(*[silver[i] for i in inputs]).createOrReplaceTempView(name)


# ------------------------------------------------------------- view builders


def build_injury_summary(injuries: DataFrame, status: str = "Injured") -> DataFrame:
    """V1: current injured players per team."""
    return (
        injuries.filter((F.col("status") == status) & (F.col("is_current") == F.lit(True)))
        .groupBy("team_id")
        .agg(F.count("player_id").alias("total_injured_players"))
    )


def build_team_form(
    matches: DataFrame,
    key: str = "team_id",
    order: Sequence[str] = ("date", "match_id"),
    value: str = "xg",
    window: int = 5,
    **kwargs,
) -> DataFrame:
    """V2: each match with the team's rolling mean over the last ``window`` rows.

    ``match_id`` breaks ties on equal dates so the frame is deterministic.
    """
    return rolling_avg(matches, key, list(order), value, -(window - 1), 0, "rolling_avg_xg", **kwargs)


def build_player_stats(shots: DataFrame, scale: int | None = None) -> DataFrame:
    """V3: shots, total and mean xG per player."""
    from tidemark.functions.exprs import exact_avg, exact_sum

    return shots.groupBy("player_id").agg(
        F.count("shot_id").alias("total_shots"),
        exact_sum("xg", scale).alias("total_expected_goals"),
        exact_avg("xg", scale).alias("avg_shot_quality"),
    )


def build_resilience_index(dim_player: DataFrame, summary: DataFrame) -> DataFrame:
    """V4: coefficient of each player's current slice."""
    cur = summary.filter(F.col("is_current") == F.lit(True))
    return dim_player.join(cur, dim_player["id"] == cur["player_id"]).select(
        dim_player["id"].alias("player_id"), "player_name", "availability_coefficient"
    )


def _home_side(fact_match: DataFrame, dim_team: DataFrame, deficit: DataFrame) -> DataFrame:
    m, t, d = fact_match.alias("m"), dim_team.alias("t"), deficit.alias("d")
    return m.join(t, F.col("m.team_h") == F.col("t.id")).join(
        d, (F.col("m.match_id") == F.col("d.match_id")) & (F.col("m.team_h") == F.col("d.team_id"))
    )


def build_squad_health_drag(fact_match: DataFrame, dim_team: DataFrame, deficit: DataFrame) -> DataFrame:
    """V5: home side only (trap T18)."""
    return _home_side(fact_match, dim_team, deficit).select(
        F.col("m.match_id").alias("match_id"),
        F.col("t.title").alias("home_team_title"),
        F.col("d.active_injured_count").alias("active_injured_count"),
        F.col("d.total_squad_xg_drag").alias("total_squad_xg_drag"),
    )


def build_efficiency_anomalies(fact_match: DataFrame, dim_team: DataFrame, deficit: DataFrame) -> DataFrame:
    """V6: points minus expected points next to the squad drag."""
    return _home_side(fact_match, dim_team, deficit).select(
        F.col("m.match_id").alias("match_id"),
        F.col("t.title").alias("home_team_title"),
        (F.col("m.pts").cast("double") - F.col("m.xpts").cast("double")).alias(
            "points_mismatch_differential"
        ),
        F.col("d.total_squad_xg_drag").alias("total_squad_xg_drag"),
    )


def build_team_health_performance(
    fact_stats: DataFrame, dim_teams: DataFrame, dim_players: DataFrame, scale: int | None = None
) -> DataFrame:
    """V7: per team and snapshot: xG, goals, current injured count, finishing efficiency.

    Facts are summed per (team_id, snapshot_date) *before* the dimension
    joins (map-side combined), and the injured count is one row per team,
    so the joins see a row per team and day, never the raw facts. With
    ``scale`` the xG sums are exact decimals, so summing the partial sums
    again after the join is exact too.
    """
    injured = (
        dim_players.filter((F.col("is_current") == F.lit(True)) & F.col("injury_status").isNotNull())
        .groupBy("team_id")
        .agg(F.count("player_id").alias("active_injuries"))
    )
    xg = F.col("xg").cast(f"decimal(18,{scale})") if scale is not None else F.col("xg")
    per_day = fact_stats.groupBy("team_id", "snapshot_date").agg(
        F.sum(xg).alias("_px"), F.sum("actual_goals").alias("_pg")
    )
    j = per_day.join(dim_teams.select("team_id", "team_name"), "team_id").join(injured, "team_id", "left")
    injured_count = F.coalesce(F.col("active_injuries"), F.lit(0)).alias("injured_player_count")
    out = j.groupBy("team_name", "snapshot_date", injured_count).agg(
        F.sum("_px").alias("_sx"), F.sum("_pg").alias("total_goals")
    )
    goals = F.col("total_goals").cast(f"decimal(38,{scale})") if scale is not None else F.col("total_goals")
    return out.select(
        "team_name",
        "snapshot_date",
        F.col("_sx").cast("double").alias("total_xg"),
        "total_goals",
        "injured_player_count",
        F.round(goals - F.col("_sx"), 2).cast("double").alias("finishing_efficiency"),
    )


def build_historical_player_impact(fact_stats: DataFrame, dim_players: DataFrame) -> DataFrame:
    """V8: the player's status at the time of each fact (point-in-time join)."""
    dim = dim_players.select(
        "player_id",
        "player_name",
        "team_name",
        "injury_status",
        F.to_date("effective_from").alias("_from"),
        F.to_date("effective_to").alias("_to"),
    )
    facts = fact_stats.select("player_id", "snapshot_date", "xg")
    j = asof_join(facts, dim, ["player_id"], "snapshot_date", "_from", "_to", open_end=None)
    return j.select(
        "player_name",
        "team_name",
        "snapshot_date",
        "xg",
        "injury_status",
        F.when(F.col("injury_status").isNotNull(), "Unavailable").otherwise("Available").alias(
            "availability_status"
        ),
    )


def governance_status(value, unit) -> "F.Column":
    # A proportion without value (an empty table) was not measured: critical.
    return (
        F.when((unit == "proportion") & (value.isNull() | (value < CRITICAL_BELOW)), STATUS_CRITICAL)
        .when((unit == "proportion") & (value < WARNING_BELOW), STATUS_WARNING)
        .otherwise(STATUS_HEALTHY)
    )


def build_data_governance_report(dq_metrics: DataFrame) -> DataFrame:
    """V9/Q3: latest snapshot's metrics with a status label."""
    # One-row aggregate joined on equality (a proven one-row broadcast side).
    latest = dq_metrics.agg(F.max("snapshot_date").alias("_latest"))
    cur = dq_metrics.join(F.broadcast(latest), F.col("snapshot_date") == F.col("_latest"))
    return cur.select(
        "table_name",
        "dimension",
        "metric_name",
        "metric_value",
        governance_status(F.col("metric_value"), F.col("unit")).alias("status"),
        "check_timestamp",
    )


def upsert_gold(target: DataFrame, source: DataFrame, pk: Sequence[str]) -> DataFrame:
    """``INSERT OR REPLACE`` a query result into a PK gold table."""
    return upsert(target, source, pk)


# View name -> (silver inputs in argument order, builder).
GOLD_VIEWS = {
    "gold_player_resilience_index": (
        ("silver_dim_player", "silver_analytics_player_injury_summary"),
        build_resilience_index,
    ),
    "gold_squad_health_drag": (
        ("silver_fact_match", "silver_dim_team", "silver_analytics_match_squad_health_deficit"),
        build_squad_health_drag,
    ),
    "gold_efficiency_anomalies": (
        ("silver_fact_match", "silver_dim_team", "silver_analytics_match_squad_health_deficit"),
        build_efficiency_anomalies,
    ),
    "gold_team_health_performance": (
        ("fact_match_stats", "dim_teams", "dim_players"),
        build_team_health_performance,
    ),
    "gold_historical_player_impact": (("fact_match_stats", "dim_players"), build_historical_player_impact),
    "gold_data_governance_report": (("dq_metrics",), build_data_governance_report),
}
