import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import ContractViolationError, DataQualityError
from tidemark.operators import dq
from tidemark.plans import gold

d = dt.date


@pytest.fixture()
def silver(spark):
    return {
        "silver_dim_player": spark.createDataFrame([(1, "Saka")], "id INT, player_name STRING"),
        "silver_dim_team": spark.createDataFrame([(10, "Arsenal")], "id INT, title STRING"),
        "silver_analytics_player_injury_summary": spark.createDataFrame(
            [(1, d(2024, 1, 1), d(9999, 12, 31), 5, 5, 0.85, True)],
            "player_id INT, valid_from DATE, valid_to DATE, injury_duration_days INT, "
            "cumulative_days_lost INT, availability_coefficient DOUBLE, is_current BOOLEAN",
        ),
        "silver_fact_match": spark.createDataFrame(
            [(100, 10, 20, "2024", 1, 1.65)], "match_id INT, team_h INT, team_a INT, season STRING, pts INT, xpts FLOAT"
        ),
        "silver_analytics_match_squad_health_deficit": spark.createDataFrame(
            [(100, 10, 2, 0.5, 0.55)],
            "match_id INT, team_id INT, active_injured_count INT, total_squad_xg_drag FLOAT, total_squad_xga_drag FLOAT",
        ),
    }


def test_gold_views_registered_from_builders(spark, silver):
    gold.register_gold_views(
        spark, silver, ["gold_player_resilience_index", "gold_squad_health_drag", "gold_efficiency_anomalies"]
    )
    assert rows(spark.table("gold_player_resilience_index")) == [(1, "Saka", 0.85)]
    assert rows(spark.table("gold_squad_health_drag")) == [(100, "Arsenal", 2, 0.5)]
    (m, title, diff, drag) = rows(spark.table("gold_efficiency_anomalies"))[0]
    assert (m, title) == (100, "Arsenal") and abs(diff - (-0.65)) < 1e-6
    df = gold.build_efficiency_anomalies(
        silver["silver_fact_match"], silver["silver_dim_team"], silver["silver_analytics_match_squad_health_deficit"]
    )
    assert rows(df) == rows(spark.table("gold_efficiency_anomalies"))
    res = gold.build_resilience_index(silver["silver_dim_player"], silver["silver_analytics_player_injury_summary"])
    assert rows(res) == [(1, "Saka", 0.85)]


def test_injury_summary_team_form_player_stats(spark):
    inj = spark.createDataFrame(
        [(1, 1, "Injured", True), (1, 2, "Injured", False), (2, 3, "Fit", True), (2, 4, "Injured", True)],
        "team_id INT, player_id INT, status STRING, is_current BOOLEAN",
    )
    assert rows(gold.build_injury_summary(inj)) == [(1, 1), (2, 1)]
    m = spark.createDataFrame(
        [(1, i, float(i), f"2024-01-0{i}") for i in range(1, 8)], "team_id INT, match_id INT, xg DOUBLE, date STRING"
    )
    form = dict(rows(gold.build_team_form(m), "match_id", "rolling_avg_xg"))
    assert form[1] == 1.0 and form[5] == 3.0 and form[7] == 5.0
    shots = spark.createDataFrame([(1, 1, 0.25), (1, 2, 0.75), (2, 3, 0.5)], "player_id INT, shot_id INT, xg DOUBLE")
    assert rows(gold.build_player_stats(shots)) == [(1, 2, 1.0, 0.5), (2, 1, 0.5, 0.5)]
    exact = gold.build_player_stats(shots.withColumn("xg", F.round("xg", 2)), scale=2)
    assert rows(exact) == [(1, 2, 1.0, 0.5), (2, 1, 0.5, 0.5)]


def test_team_health_and_point_in_time(spark):
    facts = spark.createDataFrame(
        [("p1", "t1", 0.4, 1, d(2024, 1, 5)), ("p1", "t1", 0.6, 0, d(2024, 1, 20))],
        "player_id STRING, team_id STRING, xg DOUBLE, actual_goals INT, snapshot_date DATE",
    )
    teams = spark.createDataFrame([("t1", "Arsenal")], "team_id STRING, team_name STRING")
    ts = dt.datetime
    players = spark.createDataFrame(
        [
            ("p1", "Saka", "Arsenal", "t1", None, ts(2024, 1, 1), ts(2024, 1, 10), False),
            ("p1", "Saka", "Arsenal", "t1", "knee", ts(2024, 1, 10), None, True),
        ],
        "player_id STRING, player_name STRING, team_name STRING, team_id STRING, injury_status STRING, "
        "effective_from TIMESTAMP, effective_to TIMESTAMP, is_current BOOLEAN",
    )
    perf = rows(gold.build_team_health_performance(facts, teams, players))
    assert perf == [("Arsenal", d(2024, 1, 5), 0.4, 1, 1, 0.6), ("Arsenal", d(2024, 1, 20), 0.6, 0, 1, -0.6)]
    impact = rows(gold.build_historical_player_impact(facts, players), "snapshot_date", "availability_status")
    assert impact == [(d(2024, 1, 5), "Available"), (d(2024, 1, 20), "Unavailable")]
    gold.register_gold_views(
        spark,
        {"fact_match_stats": facts, "dim_teams": teams, "dim_players": players},
        ["gold_team_health_performance", "gold_historical_player_impact"],
    )
    assert rows(spark.table("gold_historical_player_impact"), "snapshot_date", "availability_status") == impact
    assert len(rows(spark.table("gold_team_health_performance"))) == 2


def test_dq_metrics_report_gate_contract(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, "c"), (4, "d")], "k INT, name STRING")
    m = dq.measure_table(
        df, "t", d(2024, 2, 1), dt.datetime(2024, 2, 1, 6), not_null=["name"], unique=["k"],
        valid={"k_positive": F.col("k") > 0},
    )
    vals = {r.metric_name: r.metric_value for r in m.collect()}
    assert vals == {"name_not_null": 0.75, "k_unique": 0.75, "k_positive": 1.0}
    older = m.withColumn("snapshot_date", F.lit(d(2024, 1, 1)))
    report = rows(gold.build_data_governance_report(m.unionByName(older)), "metric_name", "status")
    assert report == [("k_positive", gold.STATUS_HEALTHY), ("k_unique", gold.STATUS_CRITICAL), ("name_not_null", gold.STATUS_CRITICAL)]
    with pytest.raises(DataQualityError, match="k_unique"):
        dq.dq_gate(m)
    parent = spark.createDataFrame([(1,), (2,)], "k INT")
    o = dq.orphan_share(df, "k", parent, "k", "t", d(2024, 2, 1), dt.datetime(2024, 2, 1))
    assert o.first().metric_value == 0.75
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    contract = StructType([StructField("k", IntegerType(), False), StructField("name", StringType(), False)])
    with pytest.raises(ContractViolationError, match="name: 1 NULL"):
        dq.check_contract(df, contract)
    dq.check_contract(df.dropna(), contract)
