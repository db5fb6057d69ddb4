"""One rule per case, on every path: NULL keys, ambiguous and unknown names, empty reruns, bad metrics."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import DataQualityError, IntraBatchDuplicateError, NullKeyError, UnresolvedEntityError
from tidemark.operators import dq
from tidemark.operators.asof import asof_join
from tidemark.operators.dedup import union_keep_existing
from tidemark.operators.loads import load_silver_matches, load_silver_teams, write_fact_match_stats
from tidemark.operators.merge import merge_update, upsert
from tidemark.operators.metrics import compute_match_squad_health_deficit
from tidemark.operators.resolve import resolve_source
from tidemark.operators.scd2 import scd2_apply
from tidemark.operators.sizing import BROADCAST_MAX_BYTES, broadcast_if_bounded, row_bytes
from tidemark.plans.gold import build_data_governance_report


def kv(spark, *data):
    return spark.createDataFrame(list(data), "k INT, v STRING")


def test_merges_refuse_null_keys_and_are_rerun_stable(spark):
    target = kv(spark, (1, "a"), (2, "b"))
    for merge in (lambda s: upsert(target, s, ["k"]), lambda s: merge_update(target, s, ["k"], ["v"])):
        with pytest.raises(NullKeyError):
            merge(kv(spark, (None, "x"), (3, "c")))
        once = rows(merge(kv(spark, (2, "B"), (3, "c"))))
        assert once == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(IntraBatchDuplicateError):
        upsert(target, kv(spark, (2, "x"), (2, "y")), ["k"])


def test_keep_existing_treats_null_keys_alike_on_both_paths(spark):
    state, batch = kv(spark, (1, "a"), (None, "n")), kv(spark, (None, "m"), (2, "c"), (1, "z"))
    slow = rows(union_keep_existing(state, batch, ["k"]))
    assert slow == [(None, "n"), (1, "a"), (2, "c")]
    fast = union_keep_existing(state, batch, ["k"], existing_unique=True)
    assert rows(fast) == slow and rows(union_keep_existing(fast, batch, ["k"], existing_unique=True)) == slow


def test_new_members_need_a_name(spark):
    initial = spark.createDataFrame([("x", 1)], "raw_name STRING, team_id LONG")
    with pytest.raises(NullKeyError):
        load_silver_teams(initial, spark.createDataFrame([(None,), ("y",)], "raw_name STRING"))


@pytest.mark.parametrize("bypass", [True, False])
def test_histories_of_null_keys_do_not_depend_on_the_path(spark, bypass):
    history = spark.createDataFrame(
        [(None, "A", dt.date(2024, 1, 1), dt.date(9999, 12, 31)), (1, "A", dt.date(2024, 1, 1), dt.date(9999, 12, 31))],
        "k INT, s STRING, valid_from DATE, valid_to DATE",
    )
    batch = spark.createDataFrame([(None, "B", dt.date(2024, 1, 9))], "k INT, s STRING, effective_date DATE")
    got = rows(scd2_apply(history, batch, ["k"], ["s"], bypass=bypass), "k", "s", "valid_from")
    assert got == [(None, "A", dt.date(2024, 1, 1)), (None, "B", dt.date(2024, 1, 9)), (1, "A", dt.date(2024, 1, 1))]
    opened = scd2_apply(history, batch, ["k"], ["s"], bypass=bypass, current_col="cur")
    assert opened.filter("cur and k is null").count() == 1


def test_horizon_loses_no_fact(spark):
    dim = spark.createDataFrame(
        [(1, "a", dt.date(2024, 1, 1), dt.date(2024, 5, 1)), (1, "b", dt.date(2024, 5, 1), None)],
        "k INT, s STRING, valid_from DATE, valid_to DATE",
    )
    facts = spark.createDataFrame([(1, dt.date(2024, m, 3)) for m in range(1, 9)], "k INT, d DATE")
    plain = rows(asof_join(facts, dim, ["k"], "d"))
    assert len(plain) == 8
    for horizon in (dt.date(2023, 1, 1), dt.date(2024, 3, 1), dt.date(2024, 6, 1), dt.date(2025, 1, 1)):
        assert rows(asof_join(facts, dim, ["k"], "d", horizon=horizon)) == plain


def test_empty_rerun_clears_its_partition(spark, scratch):
    path, day = os.path.join(scratch, "fact"), dt.date(2024, 2, 1)
    facts = spark.createDataFrame([("p", "t", "1.5", "2")], "player_id STRING, team_id STRING, xg STRING, goals STRING")
    write_fact_match_stats(facts, path, day)
    write_fact_match_stats(facts, path, dt.date(2024, 2, 2))
    write_fact_match_stats(facts.limit(0), path, day)
    assert [r["snapshot_date"] for r in spark.read.parquet(path).collect()] == [dt.date(2024, 2, 2)]


def test_ambiguous_mapping_is_refused(spark, scratch):
    feed, mapping = os.path.join(scratch, "feed"), os.path.join(scratch, "mapping")
    spark.createDataFrame([("n", "t")], "name STRING, team_name STRING").write.parquet(feed)
    spark.createDataFrame([("n",), ("n",)], "source_name STRING").write.parquet(mapping)
    with pytest.raises(IntraBatchDuplicateError):
        resolve_source(spark, feed, mapping, "name")


def test_unknown_teams_raise_or_are_set_aside(spark):
    initial = spark.createDataFrame([(1, 7, 7, "0-0")], "match_id INT, home_id INT, away_id INT, score STRING")
    teams = spark.createDataFrame([("A", 7), ("B", 8)], "raw_name STRING, team_id INT")
    batch = spark.createDataFrame(
        [(2, "A", "B", "1-0"), (3, "A", "Z", "2-0"), (4, None, "B", "3-0")],
        "match_id INT, home_team STRING, away_team STRING, score STRING",
    )
    with pytest.raises(UnresolvedEntityError):
        load_silver_matches(initial, batch, teams)
    loaded, aside = load_silver_matches(initial, batch, teams, policy="quarantine")
    assert rows(loaded, "match_id", "home_id", "away_id") == [(1, 7, 7), (2, 7, 8)]
    assert rows(aside, "match_id", "home_team") == [(3, "A"), (4, None)]


def test_metrics_without_value_fail(spark):
    empty = spark.createDataFrame([], "id INT")
    metrics = dq.measure_table(empty, "t", dt.date(2024, 1, 1), dt.datetime(2024, 1, 1), not_null=["id"])
    with pytest.raises(DataQualityError, match="none"):
        dq.dq_gate(metrics)
    assert "CRITICAL" in build_data_governance_report(metrics).first()["status"]


def test_broadcast_is_bounded_in_bytes(spark):
    wide = spark.range(40).select(F.repeat(F.lit("x"), 2_000_000).alias("t"))
    assert row_bytes(wide) > BROADCAST_MAX_BYTES
    assert "BroadcastHint" not in repr(broadcast_if_bounded(wide)._jdf.queryExecution().logical().toString())
    assert "broadcast" in broadcast_if_bounded(spark.range(5))._jdf.queryExecution().logical().toString().lower()


def test_squad_deficit_counts_a_repeated_roster_row_once(spark):
    injury = spark.createDataFrame([(1, 5, 9)], "player_id INT, match_id INT, team_id INT")
    roster = spark.createDataFrame([(1, 5), (1, 5)], "player_id INT, match_id INT")
    shots = spark.createDataFrame([(1, 4, 0.5), (1, 5, 0.1)], "player_id INT, match_id INT, xg DOUBLE")
    assert rows(compute_match_squad_health_deficit(injury, roster, shots), "active_injured_count", "total_squad_xg_drag") == [(1, 0.5)]
