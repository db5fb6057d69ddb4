import datetime as dt
import json
import os

import pytest

from conftest import rows
from tidemark.errors import DataQualityError
from tidemark.plans.layers import Paths, run_all
from tidemark.sources.io import latest_version


def _bronze(spark, base):
    def put(name, data, schema):
        p = os.path.join(base, name)
        spark.createDataFrame(data, schema).write.parquet(p)
        return p

    return Paths(
        teams_bronze=put("teams", [(" Arsenal",), ("Spurs",)], "title STRING"),
        injuries_bronze=put(
            "injuries",
            [("B. Saka", "Arsenal", "Knee", "50%"), ("H. Son", "Spurs", None, "Fit"), ("Nobody", "Spurs", "x", "y")],
            "player_name STRING, team STRING, reason STRING, status STRING",
        ),
        players_bronze=put(
            "players",
            [("B. Saka", "Arsenal", "3.5", "4"), ("H. Son", "Spurs", "2.0", "1")],
            "name STRING, team STRING, xg STRING, goals STRING",
        ),
        mapping=put(
            "mapping", [("B. Saka", "Bukayo Saka"), ("H. Son", "Heung-min Son")], "source_name STRING, full_name STRING"
        ),
        warehouse=os.path.join(base, "wh"),
    )


def test_end_to_end_rerun_stable(spark, scratch):
    paths = _bronze(spark, scratch)
    ts = dt.datetime(2024, 2, 1, 6)
    out = run_all(spark, paths, ts)
    first = rows(out["dim_players"])
    impact = rows(spark.table("gold_historical_player_impact"), "player_name", "availability_status")
    assert impact == [("B. Saka", "Unavailable"), ("H. Son", "Available")]
    perf = rows(spark.table("gold_team_health_performance"), "team_name", "total_goals", "injured_player_count")
    assert perf == [("Arsenal", 4, 1), ("Spurs", 1, 0)]
    report = rows(spark.table("gold_data_governance_report"), "metric_name", "status")
    assert len(report) == 5
    # second run of the same day: same dimension state, fact partition replaced not appended
    out2 = run_all(spark, paths, ts)
    assert rows(out2["dim_players"]) == first
    assert spark.read.parquet(paths.table("fact_match_stats")).count() == 2
    assert latest_version(spark, paths.table("dim_players")) == 1


def test_quality_gate_blocks_gold(spark, scratch):
    paths = _bronze(spark, scratch)
    with pytest.raises(DataQualityError):
        run_all(spark, paths, dt.datetime(2024, 2, 1, 6), dq_threshold=1.01)


def test_command_line_entry(spark, scratch):
    from tidemark.plans.layers import main

    paths = _bronze(spark, scratch)
    main([
        "--teams", paths.teams_bronze, "--injuries", paths.injuries_bronze, "--players", paths.players_bronze,
        "--mapping", paths.mapping, "--warehouse", paths.warehouse, "--processing-ts", "2024-02-01T06:00:00",
    ])
    assert spark.read.parquet(paths.table("fact_match_stats")).count() == 2


def _raw(spark, base):
    from tidemark.plans.daily import RawPaths

    def put(name, data, schema):
        path = os.path.join(base, name)
        spark.createDataFrame(data, schema).write.parquet(path)
        return path

    league = {
        "teams": {"83": {"id": "83", "title": " Arsenal"}, "82": {"id": "82", "title": "Spurs"}},
        "players": [
            {"id": "1", "player_name": "Bukayo Saka", "team_title": "Arsenal", "xG": "3.5", "goals": "4"},
            {"id": "2", "player_name": "Heung-min Son", "team_title": "Spurs", "xG": "2.0", "goals": "1"},
        ],
    }
    match = {
        "rosters": {"h": {"11": {"player_id": "1", "player": "Bukayo Saka"}}, "a": {"12": {"player_id": "2", "player": "Heung-min Son"}}},
        "shots": {"h": [{"id": "s1", "player_id": "1", "match_id": "5", "xG": "0.25"}], "a": []},
    }
    later = {
        "rosters": {"h": {"21": {"player_id": "1"}}, "a": {"22": {"player_id": "2"}}},
        "shots": {"h": [{"id": "s2", "player_id": "1", "match_id": "6", "xG": "0.5"}], "a": [{"id": "s3", "player_id": "2", "match_id": "6", "xG": "0.1"}]},
    }
    info = lambda i, goals: (
        "match_info = JSON.parse('" + json.dumps({"id": i, "team_h": "Arsenal", "team_a": "Spurs", "h_goals": goals, "a_goals": 1, "h_xg": 1.5, "a_xg": 1.5}) + "')"
    )
    cells = lambda name: "".join(f"<td>{c}" for c in (name, "Knee", "-", "May", "Bad", "50%", '<a class="track" data-id="7">x</a>'))
    grid = f"""<TABLE class="injury-table"><tr class="heading"><td><div class="injury-team">Arsenal</div></td></tr>
        <tr class="player-row">{cells("Bukayo Saka")}</tr><tr class="player-row">{cells("Nobody")}</tr></TABLE>"""
    return RawPaths(
        league=put("league", [(1, json.dumps(league))], "payload_id INT, body STRING"),
        match_data=put("match_data", [(5, json.dumps(match)), (6, json.dumps(later))], "payload_id INT, body STRING"),
        match_pages=put("match_pages", [(5, info("5", 2)), (6, info("6", 0))], "payload_id INT, html STRING"),
        injury_pages=put("injury_pages", [(1, grid)], "payload_id INT, html STRING"),
        mapping=put("mapping", [("Bukayo Saka", "Bukayo Saka"), ("Heung-min Son", "Heung-min Son")], "source_name STRING, full_name STRING"),
        warehouse=os.path.join(base, "wh"),
    )


GOLD = (
    "gold_player_resilience_index",
    "gold_squad_health_drag",
    "gold_efficiency_anomalies",
    "gold_team_health_performance",
    "gold_historical_player_impact",
    "gold_data_governance_report",
)


def test_raw_payloads_to_all_six_views_twice(spark, scratch):
    from tidemark.plans.daily import run_day

    raw = _raw(spark, scratch)
    ts = dt.datetime(2024, 2, 1, 6)
    tables = {name: rows(df) for name, df in run_day(spark, raw, ts, "2023").items()}
    views = {name: rows(spark.table(name)) for name in GOLD}
    assert tables["silver_fact_match"] == [(5, 83, 82, "2023", 3, 1.0), (6, 83, 82, "2023", 0, 1.0)]
    assert tables["silver_roster"] == [(82, 2, "2023"), (83, 1, "2023")]
    assert [r[:3] for r in tables["silver_dim_injury"]] == [(1, "Knee", "50%")]
    assert views["gold_player_resilience_index"] == [(1, "Bukayo Saka", 1.0)]
    # Saka has no match before the first, and his first match's xG before the second
    assert views["gold_squad_health_drag"] == [(5, "Arsenal", 1, None), (6, "Arsenal", 1, 0.25)]
    assert [r[:3] for r in views["gold_efficiency_anomalies"]] == [(5, "Arsenal", 2.0), (6, "Arsenal", -1.0)]
    assert [r[0] for r in views["gold_team_health_performance"]] == ["Arsenal", "Spurs"]
    assert len(views["gold_historical_player_impact"]) == 1 and views["gold_data_governance_report"]
    # the same day again: every table and view equal, no state published twice
    again = {name: rows(df) for name, df in run_day(spark, raw, ts, "2023").items()}
    assert again == tables
    assert {name: rows(spark.table(name)) for name in GOLD} == views
    for name in ("silver_fact_match", "silver_fact_shot", "silver_dim_injury", "silver_match_squad"):
        assert latest_version(spark, raw.table(name)) == 0
    # a later day, another state of the injury: the history goes on, facts stay
    later = {name: rows(df) for name, df in run_day(spark, raw, dt.datetime(2024, 2, 3, 6), "2023").items()}
    assert later["silver_fact_match"] == tables["silver_fact_match"]
    assert later["silver_dim_injury"] == tables["silver_dim_injury"]
    assert [r[4:6] for r in later["silver_analytics_player_injury_summary"]] == [(2, 2)]  # two days lost
