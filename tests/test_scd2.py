import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import FutureDateError, SCD2TimelineException
from tidemark.operators.scd2 import (
    latest_per_period,
    load_silver_injuries,
    process_injury_scd2,
    scd2_apply,
    update_injury_history,
    upsert_dim_players_scd2,
)

H = "player_id INT, status STRING, valid_from STRING, valid_to STRING"
B = "player_id INT, status STRING, effective_date STRING"
OPEN = "9999-12-31"


def test_transition_splits_open_slice(spark):
    h = spark.createDataFrame([(1, "Fit", "2024-01-01", OPEN)], H)
    b = spark.createDataFrame([(1, "Injured", "2024-01-05")], B)
    out = update_injury_history(h, b, future_bound="2026-12-31")
    assert rows(out) == [(1, "Fit", "2024-01-01", "2024-01-05"), (1, "Injured", "2024-01-05", OPEN)]


def test_same_status_is_noop(spark):
    h = spark.createDataFrame([(1, "Injured", "2024-01-01", OPEN)], H)
    b = spark.createDataFrame([(1, "Injured", "2024-01-08")], B)
    out = update_injury_history(h, b, future_bound="2026-12-31")
    assert rows(out) == [(1, "Injured", "2024-01-01", OPEN)]


def test_out_of_order_event_stitches_closed_history(spark):
    h = spark.createDataFrame([(1, "Fit", "2024-01-01", "2024-01-10"), (1, "Injured", "2024-01-10", OPEN)], H)
    b = spark.createDataFrame([(1, "Injured", "2024-01-05")], B)
    out = rows(update_injury_history(h, b, future_bound="2026-12-31"))
    assert out[:2] == [(1, "Fit", "2024-01-01", "2024-01-05"), (1, "Injured", "2024-01-05", "2024-01-10")]
    assert out[2] == (1, "Injured", "2024-01-10", OPEN)


def test_unknown_inside_closed_slice_raises(spark):
    h = spark.createDataFrame([(1, "Fit", "2024-01-01", "2024-01-10"), (1, "Injured", "2024-01-10", OPEN)], H)
    b = spark.createDataFrame([(1, "Unknown", "2024-01-05")], B)
    with pytest.raises(SCD2TimelineException):
        update_injury_history(h, b, future_bound="2026-12-31")


def test_future_date_gate(spark):
    h = spark.createDataFrame([(1, "Fit", "2024-01-01", OPEN)], H)
    b = spark.createDataFrame([(1, "Injured", "2027-01-05")], B)
    with pytest.raises(FutureDateError):
        update_injury_history(h, b, future_bound="2026-12-31")


def test_cold_start_chains_events_of_one_key(spark):
    b = spark.createDataFrame(
        [(1, "Fit", "2024-01-01"), (1, "Fit", "2024-01-02"), (1, "Injured", "2024-01-04"), (2, "Fit", "2024-01-03")], B
    )
    out = rows(scd2_apply(None, b, ["player_id"], ["status"]))
    assert out == [
        (1, "Fit", "2024-01-01", "2024-01-04"),
        (1, "Injured", "2024-01-04", OPEN),
        (2, "Fit", "2024-01-03", OPEN),
    ]


def test_load_keeps_closed_history_and_is_rerun_stable(spark):
    h = spark.createDataFrame([(1, "Fit", "2023-12-01", "2024-01-01"), (1, "Injured", "2024-01-01", OPEN)], H)
    b = spark.createDataFrame([(1, "Fit", "2024-02-01"), (2, "Injured", "2024-02-02")], B)
    once = load_silver_injuries(h, b)
    twice = load_silver_injuries(once, b)
    expected = [
        (1, "Fit", "2023-12-01", "2024-01-01"),
        (1, "Fit", "2024-02-01", OPEN),
        (1, "Injured", "2024-01-01", "2024-02-01"),
        (2, "Injured", "2024-02-02", OPEN),
    ]
    assert rows(once) == expected
    assert rows(twice) == expected


T = "player_id INT, category STRING, status STRING, valid_from DATE, valid_to DATE, is_current BOOLEAN"
TB = "player_id INT, category STRING, status STRING, effective_date DATE"


def test_backfill_closes_where_history_begins(spark):
    d = dt.date
    tgt = spark.createDataFrame([(7, "knee", "Fit", d(2026, 5, 17), d(9999, 12, 31), True)], T)
    b = spark.createDataFrame([(7, "knee", "50%", d(2026, 5, 10))], TB)
    out = rows(process_injury_scd2(tgt, b, d(2026, 5, 20)))
    assert out == [
        (7, "knee", "50%", d(2026, 5, 10), d(2026, 5, 17), False),
        (7, "knee", "Fit", d(2026, 5, 17), d(9999, 12, 31), True),
    ]


def test_batch_overlap_gate(spark):
    d = dt.date
    tgt = spark.createDataFrame([], T)
    b = spark.createDataFrame([(7, "knee", "50%", d(2026, 5, 10)), (7, "knee", "Fit", d(2026, 5, 10))], TB)
    with pytest.raises(SCD2TimelineException):
        process_injury_scd2(tgt, b, d(2026, 5, 20))


def test_cold_start_marks_current(spark):
    d = dt.date
    b = spark.createDataFrame([(7, "knee", "50%", d(2026, 5, 10))], TB)
    out = rows(process_injury_scd2(spark.createDataFrame([], T), b, d(2026, 5, 20)))
    assert out == [(7, "knee", "50%", d(2026, 5, 10), d(9999, 12, 31), True)]


def test_dim_players_snapshot_versions_null_safe(spark):
    schema = "player_id STRING, player_name STRING, team_name STRING, injury_status STRING"
    t1, t2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 2, 6)
    s1 = spark.createDataFrame([("a", "A", "X", "knee"), ("b", "B", "Y", None)], schema)
    v1 = upsert_dim_players_scd2(None, s1, t1)
    s2 = spark.createDataFrame([("a", "A", "X", None), ("b", "B", "Y", None)], schema)
    v2 = upsert_dim_players_scd2(v1, s2, t2)
    got = rows(v2, "player_id", "injury_status", "effective_from", "effective_to", "is_current")
    assert got == [
        ("a", None, t2, None, True),
        ("a", "knee", t1, t2, False),
        ("b", None, t1, None, True),
    ]
    # same snapshot again changes nothing
    assert rows(upsert_dim_players_scd2(v2, s2, dt.datetime(2024, 1, 3, 6))) == rows(v2)


def _model(events):
    """Brute-force one-shot timeline: last state per day, drop repeats, chain."""
    out = []
    for key in sorted({k for k, _, _ in events}):
        seq = sorted((d, s) for k, s, d in events if k == key)
        kept = [(d, s) for i, (d, s) in enumerate(seq) if i == 0 or seq[i - 1][1] != s]
        for i, (d, s) in enumerate(kept):
            end = kept[i + 1][0] if i + 1 < len(kept) else dt.date(9999, 12, 31)
            out.append((key, s, d, end))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_in_order_equals_one_shot(spark, seed):
    rnd = random.Random(seed)
    base = dt.date(2024, 1, 1)
    ev = {}
    for _ in range(120):
        ev[(rnd.randrange(6), rnd.randrange(40))] = rnd.choice("ABC")
    events = [(k, s, base + dt.timedelta(days=day)) for (k, day), s in ev.items()]
    df = spark.createDataFrame(events, "player_id INT, status STRING, effective_date DATE")
    cut = base + dt.timedelta(days=rnd.randrange(5, 35))
    h1 = scd2_apply(None, df.filter(F.col("effective_date") < cut), ["player_id"], ["status"])
    h2 = scd2_apply(h1, df.filter(F.col("effective_date") >= cut), ["player_id"], ["status"])
    assert rows(h2) == _model(events)
    # rerunning the second batch is a no-op; per key no overlap, at most one open slice
    h3 = scd2_apply(h2, df.filter(F.col("effective_date") >= cut), ["player_id"], ["status"])
    assert rows(h3) == rows(h2)


def test_latest_per_period_picks_last_event_of_day(spark):
    ts = dt.datetime
    ev = spark.createDataFrame(
        [(1, "a", ts(2024, 1, 1, 8), 1), (1, "b", ts(2024, 1, 1, 9), 2), (1, "c", ts(2024, 1, 1, 9), 3)],
        "player_id INT, status STRING, ts TIMESTAMP, event_id INT",
    )
    out = rows(latest_per_period(ev, ["player_id"], "ts", ["status"], tiebreak=["event_id"]))
    assert out == [(1, "c", dt.date(2024, 1, 1))]


def test_apply_many_with_checkpoints_equals_one_shot(spark):
    rnd = random.Random(11)
    base = dt.date(2024, 1, 1)
    ev = {}
    for _ in range(150):
        ev[(rnd.randrange(5), rnd.randrange(30))] = rnd.choice("AB")
    events = [(k, s, base + dt.timedelta(days=day)) for (k, day), s in ev.items()]
    df = spark.createDataFrame(events, "player_id INT, status STRING, effective_date DATE")
    days = sorted({e[2] for e in events})
    batches = [df.filter(F.col("effective_date") == F.lit(day)) for day in days]
    from tidemark.operators.scd2 import scd2_apply_many

    out = scd2_apply_many(
        None, batches, checkpoint_every=5, keys=["player_id"], tracked=["status"], current_col="is_current",
        check_batch=False,
    )
    got = rows(out, "player_id", "status", "valid_from", "valid_to")
    assert got == _model(events)


def test_bypass_and_full_sort_agree(spark):
    h = spark.createDataFrame(
        [(1, "Fit", "2024-01-01", "2024-01-10"), (1, "Injured", "2024-01-10", OPEN), (2, "Fit", "2024-01-01", OPEN)], H
    )
    b = spark.createDataFrame([(1, "Fit", "2024-01-05"), (3, "Fit", "2024-01-07")], B)
    a = scd2_apply(h, b, ["player_id"], ["status"])
    c = scd2_apply(h, b, ["player_id"], ["status"], bypass=False)
    assert rows(a) == rows(c)


@pytest.mark.parametrize("seed", [5, 6])
def test_timeline_invariants(spark, seed):
    """Per key: slices do not overlap, at most one is open; batch row order is irrelevant."""
    rnd = random.Random(seed)
    base = dt.date(2024, 1, 1)
    ev = {}
    for _ in range(200):
        ev[(rnd.randrange(8), rnd.randrange(60))] = rnd.choice("ABCD")
    events = [(k, s, base + dt.timedelta(days=day)) for (k, day), s in ev.items()]
    shuffled = events[:]
    rnd.shuffle(shuffled)
    hist_rows = None
    outs = []
    for data in (events, shuffled):
        df = spark.createDataFrame(data, "player_id INT, status STRING, effective_date DATE").repartition(3)
        h = scd2_apply(None, df.filter(F.col("effective_date") < dt.date(2024, 2, 1)), ["player_id"], ["status"])
        h = scd2_apply(h, df.filter(F.col("effective_date") >= dt.date(2024, 2, 1)), ["player_id"], ["status"],
                       current_col="is_current")
        outs.append(rows(h))
        hist_rows = h.collect()
    assert outs[0] == outs[1]
    by_key = {}
    for r in hist_rows:
        by_key.setdefault(r.player_id, []).append(r)
    for slices in by_key.values():
        slices.sort(key=lambda r: r.valid_from)
        assert sum(r.is_current for r in slices) <= 1
        for a, b in zip(slices, slices[1:]):
            assert a.valid_to <= b.valid_from
            assert a.valid_from < a.valid_to


def test_default_future_bound_is_today(spark):
    h = spark.createDataFrame([(1, "Fit", "2024-01-01", OPEN)], H)
    with pytest.raises(FutureDateError):
        update_injury_history(h, spark.createDataFrame([(1, "Injured", "2999-01-05")], B))
    assert update_injury_history(h, spark.createDataFrame([(1, "Injured", "2024-01-05")], B)).count() == 2
