"""Two-phase dedup, state fingerprints, mergeable metrics, late events, published resolution."""

import contextlib
import datetime as dt
import io
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import IntraBatchDuplicateError
from tidemark.operators import dq
from tidemark.operators.dedup import keep_first, union_keep_existing
from tidemark.operators.gates import dedupe_batch
from tidemark.operators.resolve import resolve_published
from tidemark.operators.scd2 import scd2_apply_late
from tidemark.operators.setops import assert_idempotent, changed_buckets, state_diff, state_fingerprint


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


# ------------------------------------------------------------------ dedup


def test_keep_first_orders_only_rows_of_repeated_keys(spark):
    data = [(i % 50 if i < 60 else i, i % 7, f"v{i % 3}") for i in range(200)] + [(None, 3, "n"), (None, 1, "m")]
    df = spark.createDataFrame(data, "k INT, o INT, v STRING")
    out = keep_first(df, ["k"], ["o"])
    best = {}
    for k, o, v in data:
        best[k] = min(best.get(k, (o, v)), (o, v))
    assert rows(out) == sorted(((k, o, v) for k, (o, v) in best.items()), key=lambda t: (t[0] is not None, t[0] or 0))
    plan = plan_of(out)
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan
    # nothing repeated: the rows pass by unordered
    single = spark.range(10).withColumn("v", F.lit("x"))
    assert "Window" not in plan_of(keep_first(single, ["id"]))


def test_keep_first_takes_maps_and_nested_columns(spark):
    df = spark.createDataFrame(
        [(1, {"b": 2}, [1]), (1, {"a": 1}, [2]), (1, {"a": 1}, [2]), (2, None, None), (None, {"z": 0}, [0])], "k INT, m MAP<STRING, INT>, a ARRAY<INT>"
    )
    got = {r.k: (r.m, r.a) for r in keep_first(df, ["k"]).collect()}
    assert got == {1: ({"a": 1}, [2]), 2: (None, None), None: ({"z": 0}, [0])}
    state = union_keep_existing(df.filter("k = 2"), df, ["k"])
    assert {r.k for r in state.collect()} == {1, 2, None}
    fast = union_keep_existing(df.filter("k = 2"), df, ["k"], existing_unique=True)
    assert sorted(map(str, fast.collect())) == sorted(map(str, state.collect()))


def test_keep_first_beyond_the_broadcast_bound(spark, monkeypatch):
    from tidemark.operators import dedup

    df = spark.createDataFrame([(i % 5, i) for i in range(40)], "k INT, v INT")
    monkeypatch.setattr(dedup, "is_bounded", lambda repeated: False)
    assert rows(keep_first(df, ["k"])) == [(k, k) for k in range(5)]


def test_dedupe_batch_on_copies_conflicts_and_maps(spark):
    df = spark.createDataFrame([(1, {"a": 1}, None), (1, {"a": 1}, None), (2, {"a": 2}, 0.5)], "k INT, m MAP<STRING, INT>, v DOUBLE")
    out = dedupe_batch(df, "k")
    assert sorted((r.k, r.m["a"], r.v) for r in out.collect()) == [(1, 1, None), (2, 2, 0.5)]
    assert "SortAggregate" not in plan_of(out)
    for other in ({"a": 9}, {"b": 2}):
        with pytest.raises(IntraBatchDuplicateError):
            dedupe_batch(df.unionByName(spark.createDataFrame([(2, other, 0.5)], df.schema)), "k")
    with pytest.raises(IntraBatchDuplicateError):
        dedupe_batch(df.unionByName(spark.createDataFrame([(2, {"a": 2}, None)], df.schema)), "k")
    with pytest.raises(ValueError):
        dedupe_batch(df.unionByName(spark.createDataFrame([(None, {"a": 2}, None)], df.schema)), "k")


# ------------------------------------------------------------------ fingerprints


def test_state_diff_finds_one_changed_added_or_repeated_row(spark):
    base = [(i, f"n{i}", i / 4, {"x": i}) for i in range(300)]
    schema = "id INT, name STRING, v DOUBLE, m MAP<STRING, INT>"
    before = spark.createDataFrame(base, schema).drop("m")
    assert changed_buckets(before, before.repartition(7)) == []
    cases = {
        "changed": ([*base[:5], (5, "n5", 9.0, {}), *base[6:]], [(5, "n5", 1.25)], [(5, "n5", 9.0)]),
        "added": ([*base, (999, None, None, None)], [], [(999, None, None)]),
        "repeated": ([*base, base[7]], [], [(7, "n7", 1.75)]),
        "lost": (base[1:], [(0, "n0", 0.0)], []),
        "texts moved between columns": ([*base[:5], (5, "n", 1.25, {}), *base[6:]], [(5, "n5", 1.25)], [(5, "n", 1.25)]),
    }
    for data, lost, new in cases.values():
        after = spark.createDataFrame(data, schema).drop("m")
        assert len(changed_buckets(before, after)) in (1, 2)
        gone, added = state_diff(before, after)
        assert (rows(gone), rows(added)) == (lost, new)
    empty = before.limit(0)
    assert [len(rows(side)) for side in state_diff(before, empty)] == [300, 0]
    assert state_fingerprint(empty).count() == 0
    with_map = spark.createDataFrame(base, schema)
    assert changed_buckets(with_map, with_map) == []


def test_idempotence_check_still_sees_every_change(spark):
    state = spark.createDataFrame([(1, 1), (2, 2)], "k INT, v INT")
    batch = spark.createDataFrame([(2, 5), (3, 3)], "k INT, v INT")
    out = assert_idempotent(lambda s, b: union_keep_existing(s, b, ["k"]), state, batch)
    assert rows(out) == [(1, 1), (2, 2), (3, 3)]
    with pytest.raises(AssertionError):
        assert_idempotent(lambda s, b: s.unionByName(b), state, batch)


# ------------------------------------------------------------------ metric states


def test_merged_states_equal_one_full_pass(spark):
    rng = random.Random(1)
    data = [(rng.choice([None, rng.randint(-70_000, 70_000), 5]), rng.choice([None, "a", "bb"])) for _ in range(400)]
    df = spark.createDataFrame(data, "id INT, name STRING").withColumn("day", F.monotonically_increasing_id() % 3)
    stamp = (dt.date(2024, 2, 1), dt.datetime(2024, 2, 1, 6))
    spec = {"not_null": ["id", "name"], "unique": ["id"], "valid": {"long": F.length("name") > 1}}
    want = rows(dq.measure_table(df, "t", *stamp, **spec))
    days = [dq.measure_state(df.filter(F.col("day") == day), **spec) for day in range(3)]
    assert rows(dq.state_metrics(dq.merge_states(*days), "t", *stamp)) == want
    # merged states merge again, in any order, and a state counts as a state of one load
    twice = dq.merge_states(dq.merge_states(days[2], days[0]), days[1])
    assert rows(dq.state_metrics(twice, "t", *stamp)) == want
    parents = spark.createDataFrame([(5,), (6,)], "key INT")
    orphans = dq.merge_states(*[dq.orphan_state(df.filter(F.col("day") == day), "id", parents, "key") for day in range(3)])
    assert rows(dq.state_metrics(orphans, "t", *stamp)) == rows(dq.orphan_share(df, "id", parents, "key", "t", *stamp))
    empty = dq.state_metrics(dq.measure_state(df.limit(0), **spec), "t", *stamp)
    assert {r.metric_value for r in empty.collect()} == {None} and empty.count() == 4
    with pytest.raises(ValueError, match="integer"):
        dq.measure_state(df, unique=["name"])


# ------------------------------------------------------------------ late events


def timeline(events):
    """The history of all events: {key: [(state, from, to)]}."""
    out = {}
    for k, day, state in sorted(events, key=lambda e: (e[0], e[1])):
        slices = out.setdefault(k, [])
        if not slices or slices[-1][0] != state:
            if slices:
                slices[-1] = (*slices[-1][:2], day)
            slices.append((state, day, dt.date(9999, 12, 31)))
    return sorted((k, s or "", a, b) for k, slices in out.items() for s, a, b in slices)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_loads_in_any_order_give_one_history(spark, seed):
    rng = random.Random(seed)
    events = {(k, dt.date(2024, 1, rng.randint(1, 28))): rng.choice(["a", "b", None]) for k in range(6) for _ in range(14)}
    events = [(k, day, state) for (k, day), state in events.items()]
    rng.shuffle(events)
    history = witnesses = None
    for part in (events[:20], events[20:25], events[25:60], events[60:]):
        if part:
            batch = spark.createDataFrame(part, "k INT, effective_date DATE, s STRING")
            history, witnesses = scd2_apply_late(history, witnesses, batch, ["k"], ["s"])
    got = sorted((r.k, r.s or "", r.valid_from, r.valid_to) for r in history.collect())
    assert got == timeline(events)
    assert history.count() + witnesses.count() == len(events)
    # the same load again changes nothing
    again, seen = scd2_apply_late(history, witnesses, spark.createDataFrame(events, "k INT, effective_date DATE, s STRING"), ["k"], ["s"])
    assert rows(again) == rows(history) and rows(seen) == rows(witnesses)


def test_a_correction_replaces_its_day(spark):
    d = dt.date
    schema = "k INT, effective_date DATE, s STRING"
    first = spark.createDataFrame([(1, d(2024, 1, 1), "a"), (1, d(2024, 1, 5), "b"), (2, d(2024, 1, 1), "x")], schema)
    history, witnesses = scd2_apply_late(None, None, first, ["k"], ["s"])
    history, witnesses = scd2_apply_late(history, witnesses, spark.createDataFrame([(1, d(2024, 1, 5), "a")], schema), ["k"], ["s"])
    assert rows(history, "k", "s", "valid_from") == [(1, "a", d(2024, 1, 1)), (2, "x", d(2024, 1, 1))]
    assert rows(witnesses, "k", "effective_date") == [(1, d(2024, 1, 5))]


# ------------------------------------------------------------------ resolution


def test_resolution_counts_ride_on_the_write(spark, scratch):
    feed = spark.createDataFrame([("A", "t", 1), ("B", "t", 2), (None, "t", 3), ("A", "u", 4)], "name STRING, team_name STRING, n INT")
    mapping = spark.createDataFrame([("A", "Ann")], "source_name STRING, full_name STRING")
    feed.write.parquet(f"{scratch}/feed")
    mapping.write.parquet(f"{scratch}/mapping")
    stored, counts = resolve_published(spark, f"{scratch}/feed", f"{scratch}/mapping", "name")
    assert rows(counts) == [(4, 2, 2)]
    assert rows(stored, "n") == [(1,), (4,)] and {"player_id", "team_id"} <= set(stored.columns)
