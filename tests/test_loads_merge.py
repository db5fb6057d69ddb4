import datetime as dt

from conftest import rows
from tidemark.operators.loads import (
    assign_ids,
    load_silver_matches,
    load_silver_players,
    load_silver_rosters,
    load_silver_shots,
    load_silver_teams,
    upsert_dim_teams,
)
from tidemark.operators.merge import merge_update, upsert
from tidemark.operators.scd2 import load_silver_injuries
from tidemark.operators.setops import assert_idempotent, set_difference, state_diff, union_by_name


def test_matches_align_names_and_are_idempotent(spark):
    teams = spark.createDataFrame([("Arsenal", 1), ("Spurs", 2)], "raw_name STRING, team_id INT")
    initial = spark.createDataFrame([(1, 1, 2, "1-0")], "match_id INT, home_id INT, away_id INT, score STRING")
    batch = spark.createDataFrame([(1, "Spurs", "Arsenal", "0-0"), (2, "Spurs", "Arsenal", "2-2")],
                                  "match_id INT, home_team STRING, away_team STRING, score STRING")
    once = assert_idempotent(lambda s, b: load_silver_matches(s, b, teams), initial, batch)
    assert rows(once) == [(1, 1, 2, "1-0"), (2, 2, 1, "2-2")]


def test_new_members_get_ids_after_max(spark):
    initial = spark.createDataFrame([(5, "Arsenal")], "team_id BIGINT, raw_name STRING")
    batch = spark.createDataFrame([("Arsenal",), ("Spurs",), ("Everton",), ("Spurs",)], "raw_name STRING")
    once = assert_idempotent(load_silver_teams, initial, batch)
    got = dict(rows(once, "raw_name", "team_id"))
    assert got["Arsenal"] == 5 and sorted(got.values()) == [5, 6, 7]
    p = load_silver_players(spark.createDataFrame([], "player_id BIGINT, raw_name STRING"), batch)
    assert sorted(r.player_id for r in p.collect()) == [1, 2, 3]


def test_assign_ids_matches_md5_order(spark):
    import hashlib

    names = [f"name{i}" for i in range(300)]
    df = spark.createDataFrame([(n,) for n in names], "raw_name STRING")
    got = dict(rows(assign_ids(df, "raw_name", "id", 100)))
    order = sorted(names, key=lambda n: (hashlib.md5(n.encode()).hexdigest(), n))
    assert got == {n: 101 + i for i, n in enumerate(order)}


def test_shots_rosters_injuries_idempotent(spark):
    shots = spark.createDataFrame([(1, 1, 1, 0.1)], "shot_id INT, match_id INT, player_id INT, xG FLOAT")
    sb = spark.createDataFrame([(1, 1, 1, 0.9), (2, 1, 1, 0.2)], "shot_id INT, match_id INT, player_id INT, xG FLOAT")
    assert rows(assert_idempotent(load_silver_shots, shots, sb), "shot_id") == [(1,), (2,)]
    ro = spark.createDataFrame([(1, 1, "2024")], "team_id INT, player_id INT, season STRING")
    rb = spark.createDataFrame([(1, 1, "2024"), (1, 2, "2024")], "team_id INT, player_id INT, season STRING")
    assert assert_idempotent(load_silver_rosters, ro, rb).count() == 2
    ih = spark.createDataFrame([(1, "Fit", "2024-01-01", "9999-12-31")], "player_id INT, status STRING, valid_from STRING, valid_to STRING")
    ib = spark.createDataFrame([(1, "Injured", "2024-01-05")], "player_id INT, status STRING, effective_date STRING")
    assert assert_idempotent(load_silver_injuries, ih, ib).count() == 2


def test_upsert_and_conditional_merge(spark):
    tgt = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k INT, name STRING, v DOUBLE")
    src = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0)], "k INT, name STRING, v DOUBLE")
    assert rows(upsert(tgt, src, ["k"])) == [(1, "a", 1.0), (2, "B", 20.0), (3, "c", 3.0)]
    assert rows(upsert(upsert(tgt, src, ["k"]), src, ["k"])) == rows(upsert(tgt, src, ["k"]))
    only_v = merge_update(tgt, src, ["k"], ["v"], insert=False)
    assert rows(only_v) == [(1, "a", 1.0), (2, "b", 20.0)]
    cond = merge_update(tgt, src.filter("k = 2").selectExpr("k", "'b' AS name", "99.0 AS v"), ["k"], ["v"], only_if_changed=["name"])
    assert rows(cond) == [(1, "a", 1.0), (2, "b", 2.0)]


def test_dim_teams_trimmed_hash_merge(spark):
    ts = dt.datetime(2024, 1, 1)
    raw = spark.createDataFrame([(" Arsenal ",), ("Arsenal",), ("Spurs",)], "title STRING")
    first = upsert_dim_teams(None, raw, "title", ts)
    assert first.count() == 2
    again = upsert_dim_teams(first, raw, "title", dt.datetime(2024, 1, 2))
    assert rows(again, "team_name") == [("Arsenal",), ("Spurs",)]
    assert {r.updated_at for r in again.collect()} == {dt.datetime(2024, 1, 2)}


def test_set_ops(spark):
    a = spark.createDataFrame([(1,), (1,), (None,), (2,)], "k INT")
    b = spark.createDataFrame([(None,), (2,)], "k INT")
    assert rows(set_difference(a, b)) == [(1,)]
    c = spark.createDataFrame([(1, "x")], "k INT, extra STRING")
    assert rows(union_by_name(b, c), "k", "extra") == [(None, None), (1, "x"), (2, None)]
    gone, added = state_diff(a, b)
    assert gone.count() == 2 and added.count() == 0


def test_merge_source_must_be_unique(spark):
    import pytest

    from tidemark.errors import IntraBatchDuplicateError

    tgt = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    src = spark.createDataFrame([(2, "b"), (2, "c")], "k INT, v STRING")
    with pytest.raises(IntraBatchDuplicateError):
        upsert(tgt, src, ["k"])
    with pytest.raises(IntraBatchDuplicateError):
        merge_update(tgt, src, ["k"], ["v"])


def test_set_diff_reads_orders_of_every_status(spark, scratch):
    import duckdb

    from tidemark.plans.catalog import ORACLE_SQL, QUERIES

    spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 4)], "c_custkey LONG").write.parquet(f"{scratch}/customer.parquet")
    orders = [(10, 1, "P"), (11, 2, "F"), (12, 3, "O"), (13, 9, "P")]
    spark.createDataFrame(orders, "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING").write.parquet(f"{scratch}/orders.parquet")
    assert rows(QUERIES["set_diff"](spark, scratch)) == [(4,)]
    con = duckdb.connect()
    for name in ("customer", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{scratch}/{name}.parquet/*.parquet')")
    assert con.execute(ORACLE_SQL["set_diff"]).fetchall() == [(4,)]
