import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import IntraBatchDuplicateError, UnresolvedEntityError
from tidemark.operators.dedup import keep_first, union_keep_existing
from tidemark.operators.gates import dedupe_batch, duplicate_keys, validate_composite_keys
from tidemark.operators.resolve import (
    log_gap,
    resolve_entities,
    resolve_player_entities,
    resolve_player_identities,
    resolve_team_entities,
)


def test_resolve_teams(spark):
    inp = spark.createDataFrame([("Arsenal", 2), ("Spurs", 1)], "team_name STRING, goals BIGINT")
    lk = spark.createDataFrame([("Arsenal", 1), ("Spurs", 2)], "raw_name STRING, team_id BIGINT")
    out = resolve_team_entities(inp, lk)
    assert "team_name" not in out.columns
    assert rows(out, "raw_name", "team_id", "goals") == [("Arsenal", 1, 2), ("Spurs", 2, 1)]


def test_resolve_players_raises_with_culprit(spark):
    inp = spark.createDataFrame([("Ødegaard", 0.4), ("Zé", 0.1), ("Ángel", 0.2)], "player_name STRING, xg DOUBLE")
    lk = spark.createDataFrame([("Ødegaard", 8)], "raw_player_name STRING, player_id BIGINT")
    with pytest.raises(UnresolvedEntityError, match="Unresolved entity detected: Zé|Unresolved entity detected: Ángel"):
        resolve_player_entities(inp, lk)


def test_null_key_is_unresolved(spark):
    inp = spark.createDataFrame([(None, 1)], "team_name STRING, goals BIGINT")
    lk = spark.createDataFrame([(None, 1)], "raw_name STRING, team_id BIGINT")
    with pytest.raises(UnresolvedEntityError):
        resolve_team_entities(inp, lk)


def test_ambiguous_mapping_is_rejected(spark):
    inp = spark.createDataFrame([("A", 1)], "team_name STRING, goals BIGINT")
    lk = spark.createDataFrame([("A", 1), ("A", 2)], "raw_name STRING, team_id BIGINT")
    with pytest.raises(IntraBatchDuplicateError):
        resolve_team_entities(inp, lk)


def test_quarantine_and_warn(spark):
    inp = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "team_name STRING, goals BIGINT")
    lk = spark.createDataFrame([("A", 10)], "raw_name STRING, team_id BIGINT")
    ok, bad = resolve_entities(inp, lk, "team_name", "raw_name", policy="quarantine")
    assert rows(ok, "team_id", "goals") == [(10, 1)]
    assert rows(bad, "goals") == [(2,), (3,)]
    out, report = resolve_entities(inp, lk, "team_name", "raw_name", policy="warn")
    assert out.count() == 1
    assert log_gap(report, "test") == 2


def test_resolve_identities(spark):
    raw = spark.createDataFrame([("a",), ("b",)], "raw_name STRING")
    m = spark.createDataFrame([("a", 1), ("b", 2)], "raw_name STRING, player_id BIGINT")
    assert rows(resolve_player_identities(raw, m)) == [(1, "a"), (2, "b")]
    with pytest.raises(UnresolvedEntityError):
        resolve_player_identities(raw, m.filter("raw_name = 'a'"))


def test_composite_key_gate_fails_on_exact_copies(spark):
    df = spark.createDataFrame([(1, 2, 0.1, "a"), (1, 2, 0.1, "a")], "player_id INT, match_id INT, xg DOUBLE, shot_type STRING")
    with pytest.raises(IntraBatchDuplicateError):
        validate_composite_keys(df, ["player_id", "match_id", "xg"])
    validate_composite_keys(df.limit(1), ["player_id", "match_id", "xg"])
    assert rows(duplicate_keys(df, ["player_id"])) == [(1, 2)]


def test_dedupe_batch(spark):
    exact = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "id INT, name STRING")
    assert rows(dedupe_batch(exact, "id")) == [(1, "a"), (2, "b")]
    clash = spark.createDataFrame([(1, "a"), (1, "z")], "id INT, player STRING")
    with pytest.raises(IntraBatchDuplicateError):
        dedupe_batch(clash, "id")
    nullpk = spark.createDataFrame([(None, "a")], "id INT, name STRING")
    with pytest.raises(ValueError):
        dedupe_batch(nullpk, "id")


def test_keep_first_is_deterministic_and_existing_wins(spark):
    old = spark.createDataFrame([(1, "old")], "shot_id INT, v STRING")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a")], "shot_id INT, v STRING")
    assert rows(union_keep_existing(old, new, ["shot_id"])) == [(1, "old"), (2, "a")]
    df = spark.createDataFrame([(1, 3, "x"), (1, 1, "y"), (1, 1, "a")], "k INT, o INT, v STRING")
    assert rows(keep_first(df, ["k"], [F.col("o")])) == [(1, 1, "a")]


def test_unique_existing_fast_path_agrees(spark):
    old = spark.createDataFrame([(1, "old"), (3, "c")], "shot_id INT, v STRING")
    new = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (4, None)], "shot_id INT, v STRING")
    slow = union_keep_existing(old, new, ["shot_id"])
    fast = union_keep_existing(old, new, ["shot_id"], existing_unique=True)
    assert rows(fast) == rows(slow) == [(1, "old"), (2, "a"), (3, "c"), (4, None)]
