"""One processing day from raw payloads to all six gold views.

1. bronze: X1-X8 over the day's payload tables, one table per dataset and day;
2. silver: dimensions, facts and injury history (L1-L4, D3), each the stored
   state plus the day's batch; then the metrics M1 and M2 over them;
3. the warehouse layers of ``plans.layers`` over the same bronze tables:
   team and player dimensions, fact snapshot, data-quality gate;
4. the six gold views.

A day can be run again at any time: bronze partitions are replaced, and a
state is published as a new version only where its fingerprint has changed.
"""

from __future__ import annotations

import datetime as _dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import clean_whitespace
from tidemark.operators.dedup import keep_first, union_keep_existing
from tidemark.operators.extract import (
    extract_id_title,
    extract_injury_grid,
    extract_injury_status,
    extract_league_players,
    extract_match_info,
    extract_rosters,
    extract_shots,
)
from tidemark.operators.loads import load_silver_matches, load_silver_rosters, load_silver_shots
from tidemark.operators.metrics import compute_match_squad_health_deficit, compute_player_injury_summary
from tidemark.operators.scd2 import process_injury_scd2
from tidemark.operators.setops import changed_buckets
from tidemark.plans.gold import register_gold_views
from tidemark.plans.layers import Paths, run_all
from tidemark.sources.io import publish_version, read_latest, read_source, write_partition

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class RawPaths:
    """Payload tables (``payload_id`` with ``body`` or ``html``), the governance mapping, the warehouse folder."""

    league: str  # league documents: players, teams
    match_data: str  # one document per match, ``payload_id`` is the match: rosters, shots
    match_pages: str  # match pages with the embedded match info
    injury_pages: str  # injury grid pages
    mapping: str  # source_name -> full_name, the verified name
    warehouse: str

    def table(self, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/{name}"


def extract_day(spark: SparkSession, raw: RawPaths, day: _dt.date) -> dict[str, str]:
    """Bronze: every dataset of the day extracted and stored; returns its paths."""
    league = read_source(spark, raw.league)
    matches = read_source(spark, raw.match_data)
    injuries = read_source(spark, raw.injury_pages)
    made = {
        "league_players": extract_league_players(league),
        "teams": extract_id_title(league, "teams"),
        "players": extract_id_title(league, "players"),
        "match_info": extract_match_info(read_source(spark, raw.match_pages)),
        "rosters": extract_rosters(matches),
        "shots": extract_shots(matches),
        "injuries": extract_injury_grid(injuries),
        "injury_status": extract_injury_status(injuries),
    }
    paths = {}
    for name, rows in made.items():
        base = raw.table(f"bronze/{name}")
        write_partition(rows, base, "day", day.isoformat())
        paths[name] = f"{base}/day={day.isoformat()}"
    return paths


def _publish(spark: SparkSession, raw: RawPaths, name: str, state: DataFrame) -> DataFrame:
    """The state under ``name``, as a new version if it differs from the stored one."""
    before = read_latest(spark, raw.table(name))
    if before is None or before.columns != state.columns or changed_buckets(before, state):
        publish_version(state, raw.table(name))
    return read_latest(spark, raw.table(name))


def _stored(spark: SparkSession, raw: RawPaths, name: str, like: DataFrame) -> DataFrame:
    found = read_latest(spark, raw.table(name))
    return like.limit(0) if found is None else found


def _points(own, other):
    return F.when(own > other, 3).when(own == other, 1).otherwise(0)


def load_silver(spark: SparkSession, raw: RawPaths, bronze: dict[str, str], day: _dt.date, season: str) -> dict[str, DataFrame]:
    """Silver: dimensions, facts, injury history and the two metrics, each merged with its stored state.

    ``pts`` and ``xpts`` are the home side's points by goals and by expected
    goals. Injured players are found by their verified name; names without a
    mapping or without a player are counted in the log and left out.
    """
    read = {name: spark.read.parquet(path) for name, path in bronze.items()}
    teams = read["teams"].select("id", clean_whitespace("title").alias("title"))
    silver = {"silver_dim_team": _publish(spark, raw, "silver_dim_team", union_keep_existing(_stored(spark, raw, "silver_dim_team", teams), teams, ["id"]))}
    players = read["players"].select("id", clean_whitespace("title").alias("player_name"))
    silver["silver_dim_player"] = _publish(
        spark, raw, "silver_dim_player", union_keep_existing(_stored(spark, raw, "silver_dim_player", players), players, ["id"])
    )

    # L1: matches by team names, aligned through the team dimension.
    info = read["match_info"]
    batch = info.select(
        F.col("match_id").cast("int").alias("match_id"),
        clean_whitespace("home_team").alias("home_team"),
        clean_whitespace("away_team").alias("away_team"),
        F.lit(season).alias("season"),
        _points(F.col("home_goals"), F.col("away_goals")).cast("int").alias("pts"),
        _points(F.col("home_xg"), F.col("away_xg")).cast("float").alias("xpts"),
    )
    names = silver["silver_dim_team"].select(F.col("title").alias("raw_name"), F.col("id").alias("team_id"))
    order = ["match_id", "home_id", "away_id", "season", "pts", "xpts"]
    stored = read_latest(spark, raw.table("silver_fact_match"))
    empty = spark.createDataFrame([], "match_id INT, home_id INT, away_id INT, season STRING, pts INT, xpts FLOAT")
    state = empty if stored is None else stored.withColumnsRenamed({"team_h": "home_id", "team_a": "away_id"})
    state = load_silver_matches(state, batch, names).select(*order)
    matches = _publish(spark, raw, "silver_fact_match", state.withColumnsRenamed({"home_id": "team_h", "away_id": "team_a"}))
    silver["silver_fact_match"] = matches

    # L3, L4 and the match rosters.
    shots = read["shots"].select(
        F.col("id").alias("shot_id"), F.col("player_id").cast("int"), F.col("match_id").cast("int"), F.col("xg").cast("float")
    )
    prev = _stored(spark, raw, "silver_fact_shot", shots.withColumnRenamed("shot_id", "id")).withColumnRenamed("id", "shot_id")
    silver["silver_fact_shot"] = _publish(spark, raw, "silver_fact_shot", load_silver_shots(prev, shots).withColumnRenamed("shot_id", "id"))
    side = read["rosters"].select(F.col("player_id").cast("int"), F.col("payload_id").cast("int").alias("match_id"), "team_side")
    team = F.when(F.col("team_side") == "h", F.col("team_h")).otherwise(F.col("team_a"))
    fielded = side.join(matches, "match_id").select("player_id", "match_id", team.alias("team_id"), "season").distinct()
    played = _stored(spark, raw, "silver_match_squad", fielded)
    squad = _publish(spark, raw, "silver_match_squad", union_keep_existing(played, fielded, ["player_id", "match_id"]))
    silver["silver_fact_roster"] = _publish(spark, raw, "silver_fact_roster", squad.select("player_id", "match_id"))
    season_squad = squad.select("team_id", "player_id", "season").distinct()
    silver["silver_roster"] = _publish(
        spark, raw, "silver_roster", load_silver_rosters(_stored(spark, raw, "silver_roster", season_squad), season_squad)
    )

    # D3: the day's injury grid against the history, by player and category.
    mapping = read_source(spark, raw.mapping).select(F.col("source_name").alias("_source"), clean_whitespace("full_name").alias("_name"))
    grid = read["injuries"].join(mapping, F.col("player_name") == F.col("_source"), "left")
    by_name = silver["silver_dim_player"].select(F.col("id").alias("player_id"), F.col("player_name").alias("_player"))
    found = grid.join(by_name, F.col("_name") == F.col("_player"), "left")
    lost = found.filter(F.col("player_id").isNull()).count()
    if lost:
        log.warning("%d injured players have no verified name or no player and were left out", lost)
    events = keep_first(
        found.filter(F.col("player_id").isNotNull()).select(
            "player_id",
            F.col("reason").alias("category"),
            "status",
            F.lit(day).alias("effective_date"),
        ),
        ["player_id", "category", "effective_date"],
        ["status"],
    )
    history = _publish(
        spark, raw, "silver_dim_injury", process_injury_scd2(read_latest(spark, raw.table("silver_dim_injury")), events, day)
    )
    silver["silver_dim_injury"] = history

    # M1 over one slice per player and start, M2 over the current injuries of each match's squad.
    slices = keep_first(history, ["player_id", "valid_from"], ["category"])
    summary = compute_player_injury_summary(slices, day).drop("category", "status")
    silver["silver_analytics_player_injury_summary"] = _publish(spark, raw, "silver_analytics_player_injury_summary", summary)
    hurt = history.filter("is_current").select("player_id").distinct()
    absent = squad.join(hurt, "player_id", "left_semi").select("player_id", "match_id", "team_id")
    deficit = compute_match_squad_health_deficit(
        absent, silver["silver_fact_roster"], silver["silver_fact_shot"].withColumnRenamed("id", "shot_id"), how="left"
    )
    silver["silver_analytics_match_squad_health_deficit"] = _publish(
        spark, raw, "silver_analytics_match_squad_health_deficit", deficit
    )
    return silver


def run_day(
    spark: SparkSession, raw: RawPaths, processing_ts: _dt.datetime, season: str, dq_threshold: float = 0.95
) -> dict[str, DataFrame]:
    """Raw payloads to the six gold views for one day; returns every silver table."""
    day = processing_ts.date()
    bronze = extract_day(spark, raw, day)
    silver = load_silver(spark, raw, bronze, day, season)
    paths = Paths(bronze["teams"], bronze["injuries"], bronze["league_players"], raw.mapping, raw.warehouse)
    silver |= run_all(spark, paths, processing_ts, dq_threshold)
    register_gold_views(spark, silver)
    return silver


def main(argv: list[str] | None = None) -> None:
    """``spark-submit --py-files tidemark.zip tidemark/plans/daily.py --league ... --processing-ts ...``."""
    import argparse

    from tidemark.session import build_session

    p = argparse.ArgumentParser(description="Run one day from raw payloads to the gold views")
    for name in ("league", "match-data", "match-pages", "injury-pages", "mapping", "warehouse", "processing-ts", "season"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--dq-threshold", type=float, default=0.95)
    a = p.parse_args(argv)
    raw = RawPaths(a.league, a.match_data, a.match_pages, a.injury_pages, a.mapping, a.warehouse)
    run_day(build_session(app_name="tidemark-day"), raw, _dt.datetime.fromisoformat(a.processing_ts), a.season, a.dq_threshold)


if __name__ == "__main__":
    main()
