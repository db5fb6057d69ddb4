import os

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.scd2 import latest_per_period, scd2_apply
from tidemark.schemas import SILVER, create_tables
from tidemark.sources.io import read_latest
from tidemark.streaming.incremental import start_scd2_stream

EVENTS = "/root/testdata/sf0.001/events.parquet"


def test_stream_matches_batch_history(spark, scratch):
    ev = spark.read.parquet(EVENTS).select(
        F.col("user_id").alias("player_id"), F.col("event_type").alias("status"), "ts", "event_id"
    )
    src = os.path.join(scratch, "landing")
    cut = F.to_date("ts") < F.lit("2024-01-16")
    ev.filter(cut).coalesce(1).write.parquet(os.path.join(src, "part1"))
    hist, ckpt = os.path.join(scratch, "history"), os.path.join(scratch, "ckpt")
    kw = dict(keys=["player_id"], tracked=["status"], ts_col="ts", tiebreak=["event_id"])
    # the landing folder is read recursively by file name; run twice as files arrive
    schema = ev.schema
    q = start_scd2_stream(spark, os.path.join(src, "*"), schema, hist, ckpt, **kw)
    q.awaitTermination()
    ev.filter(~cut).coalesce(1).write.parquet(os.path.join(src, "part2"))
    q = start_scd2_stream(spark, os.path.join(src, "*"), schema, hist, ckpt, **kw)
    q.awaitTermination()
    got = read_latest(spark, hist)
    daily = latest_per_period(ev, ["player_id"], "ts", ["status"], tiebreak=["event_id"])
    expected = scd2_apply(None, daily, ["player_id"], ["status"], current_col="is_current")
    assert rows(got) == rows(expected.select(*got.columns))


def test_create_registered_tables(spark):
    create_tables(spark, "tidemark_test_ns", {"silver_dim_team": SILVER["silver_dim_team"], "fact_match_stats": SILVER["fact_match_stats"]})
    create_tables(spark, "tidemark_test_ns", {"silver_dim_team": SILVER["silver_dim_team"]})  # idempotent
    cols = [c.name for c in spark.catalog.listColumns("tidemark_test_ns.silver_dim_team")]
    assert cols == ["id", "title"]


def test_stream_late_event_does_not_override_later_one(spark, scratch):
    import datetime as dt

    from tidemark.sources.io import latest_version

    schema = "player_id INT, status STRING, ts TIMESTAMP, event_id INT"
    src = os.path.join(scratch, "landing")
    hist, ckpt = os.path.join(scratch, "history"), os.path.join(scratch, "ckpt")
    kw = dict(keys=["player_id"], tracked=["status"], ts_col="ts", tiebreak=["event_id"], watermark="30 days")
    first = spark.createDataFrame([(1, "A", dt.datetime(2024, 1, 1, 10), 1)], schema)
    first.write.parquet(os.path.join(src, "p1"))
    q = start_scd2_stream(spark, os.path.join(src, "*"), first.schema, hist, ckpt, **kw)
    q.awaitTermination()
    late = spark.createDataFrame(
        [(1, "B", dt.datetime(2024, 1, 1, 9), 2), (1, "C", dt.datetime(2024, 1, 2, 10), 3)], schema
    )
    late.write.parquet(os.path.join(src, "p2"))
    q = start_scd2_stream(spark, os.path.join(src, "*"), first.schema, hist, ckpt, **kw)
    q.awaitTermination()
    got = rows(read_latest(spark, hist), "player_id", "status", "valid_from", "valid_to")
    assert got == [(1, "A", dt.date(2024, 1, 1), dt.date(2024, 1, 2)), (1, "C", dt.date(2024, 1, 2), dt.date(9999, 12, 31))]
    # nothing new: a restart publishes no further version
    v = latest_version(spark, hist)
    q = start_scd2_stream(spark, os.path.join(src, "*"), first.schema, hist, ckpt, **kw)
    q.awaitTermination()
    assert latest_version(spark, hist) == v


def test_contract_against_registry(spark):
    import datetime as dt

    import pytest

    from tidemark.errors import ContractViolationError
    from tidemark.operators.dq import check_contract

    spec = SILVER["silver_dim_injury"]
    good = spark.createDataFrame(
        [(1, "knee", "Fit", dt.date(2024, 1, 1), dt.date(9999, 12, 31), True)], spec.schema
    )
    check_contract(good, spec.schema, spec.not_null)
    bad = good.withColumn("player_id", good["player_id"].cast("string"))
    with pytest.raises(ContractViolationError, match="player_id"):
        check_contract(bad, spec.schema, spec.not_null)


def test_stream_takes_days_in_any_order(spark, scratch):
    """A day that changed nothing when it came still holds when an earlier day arrives after it."""
    import datetime as dt

    d = dt.date
    schema = "player_id INT, status STRING, ts TIMESTAMP, event_id INT"
    src, hist, ckpt = (os.path.join(scratch, name) for name in ("landing", "history", "ckpt"))
    kw = dict(keys=["player_id"], tracked=["status"], ts_col="ts", tiebreak=["event_id"], watermark="30 days")
    days = [[(1, "A"), (5, "A"), (9, "C")], [(3, "B")], [(7, "C"), (2, "A")]]
    for part, events in enumerate(days):
        df = spark.createDataFrame([(1, s, dt.datetime(2024, 1, day, 10), 10 * part + day) for day, s in events], schema)
        df.write.parquet(os.path.join(src, f"p{part}"))
        start_scd2_stream(spark, os.path.join(src, "*"), df.schema, hist, ckpt, **kw).awaitTermination()
    got = rows(read_latest(spark, hist), "status", "valid_from", "valid_to", "is_current")
    assert sorted(got, key=lambda r: r[1]) == [
        ("A", d(2024, 1, 1), d(2024, 1, 3), False),
        ("B", d(2024, 1, 3), d(2024, 1, 5), False),
        ("A", d(2024, 1, 5), d(2024, 1, 7), False),
        ("C", d(2024, 1, 7), d(9999, 12, 31), True),
    ]
    assert rows(read_latest(spark, f"{hist}_witnesses"), "effective_date") == [(d(2024, 1, 2),), (d(2024, 1, 9),)]
