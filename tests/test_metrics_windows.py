import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.metrics import compute_match_squad_health_deficit, compute_player_injury_summary, player_baselines
from tidemark.operators.windows import rolling_avg, running_sum

d = dt.date
S = "player_id INT, valid_from DATE, valid_to DATE"


def test_open_slice_runs_to_processing_date(spark):
    df = spark.createDataFrame([(1, d(2024, 5, 10), d(9999, 12, 31))], S)
    out = compute_player_injury_summary(df, d(2024, 5, 15)).first()
    assert out.injury_duration_days == 5
    assert out.cumulative_days_lost == 5
    assert abs(out.availability_coefficient - (295 / 300)) < 1e-12


def test_cumulative_days_lost(spark):
    df = spark.createDataFrame([(1, d(2024, 1, 1), d(2024, 1, 6)), (1, d(2024, 2, 1), d(2024, 2, 6))], S)
    out = rows(compute_player_injury_summary(df, d(2024, 3, 1)), "valid_from", "cumulative_days_lost")
    assert out == [(d(2024, 1, 1), 5), (d(2024, 2, 1), 10)]


def test_coefficient_unclamped_unless_asked(spark):
    df = spark.createDataFrame([(1, d(2023, 1, 1), d(2024, 1, 1))], S)
    assert compute_player_injury_summary(df, d(2024, 3, 1)).first().availability_coefficient < 0
    assert compute_player_injury_summary(df, d(2024, 3, 1), clamp=True).first().availability_coefficient == 0.0


def test_lookback_excludes_current_match(spark):
    shots = spark.createDataFrame(
        [(10, 1, 1, 0.2), (10, 2, 2, 0.4), (10, 3, 3, 0.1)], "player_id INT, match_id INT, shot_id INT, xg DOUBLE"
    )
    out = rows(player_baselines(shots), "match_id", "rolling_player_xg_5match")
    assert out[0] == (1, None)
    assert abs(out[2][1] - 0.3) < 1e-12
    xga = {r.match_id: r.rolling_player_xga_5match for r in player_baselines(shots).collect()}
    assert abs(xga[3] - 0.33) < 1e-12


def test_squad_deficit(spark):
    injury = spark.createDataFrame([(10, 3, 100), (11, 3, 100)], "player_id INT, match_id INT, team_id INT")
    roster = spark.createDataFrame([(10, 3), (11, 3)], "player_id INT, match_id INT")
    shots = spark.createDataFrame(
        [(10, 1, 1, 0.2), (10, 2, 2, 0.4), (10, 3, 3, 0.1), (11, 2, 4, 0.5), (11, 3, 5, 0.3)],
        "player_id INT, match_id INT, shot_id INT, xg DOUBLE",
    )
    r = compute_match_squad_health_deficit(injury, roster, shots).first()
    assert (r.match_id, r.team_id, r.active_injured_count) == (3, 100, 2)
    assert abs(r.total_squad_xg_drag - 0.8) < 1e-12
    assert abs(r.total_squad_xga_drag - 0.88) < 1e-12


def _random_frame(spark, seed, n=400):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        key = 0 if rnd.random() < 0.4 else rnd.randrange(1, 6)  # key 0 is hot
        data.append((key, i, rnd.randrange(0, 3000), None if rnd.random() < 0.05 else round(rnd.random(), 2)))
    return spark.createDataFrame(data, "k INT, id INT, t INT, v DOUBLE")


def test_split_rolling_equals_plain_window(spark):
    for seed, (lo, hi) in [(1, (-5, -1)), (2, (-4, 0)), (3, (-2, -2))]:
        df = _random_frame(spark, seed)
        plain = rolling_avg(df, "k", ["t", "id"], "v", lo, hi, "r", scale=2)
        split = rolling_avg(df, "k", ["t", "id"], "v", lo, hi, "r", scale=2, range_rows=50)
        everything = rolling_avg(df, "k", ["t", "id"], "v", lo, hi, "r", scale=2, range_rows=3)
        assert rows(split) == rows(plain)
        assert rows(everything) == rows(plain)


def test_split_running_sum_equals_plain_window(spark):
    df = _random_frame(spark, 4).withColumn("n", F.col("t") % 17)
    plain = running_sum(df, "k", ["t", "id"], "n", "c")
    split = running_sum(df, "k", ["t", "id"], "n", "c", range_rows=50)
    assert rows(split) == rows(plain)


def test_hot_key_on_one_date_is_split(spark):
    from tidemark.operators.windows import _dealt, ranges_of

    n = 9000
    # key 0 holds a third of the rows, all on one date; the rest spread over 600 keys
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 600 + 1).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("t"),
        "id",
        (F.col("id") % 7).cast("double").alias("v"),
    )
    ranges = ranges_of(df, "k", ["t", "id"], 100)
    assert ranges_of(df, "k", ["t", "id"], n) is None
    groups = _dealt(df, ranges, ["t", "id"]).groupBy("k", "_b").count()
    assert groups.agg(F.max("count")).first()[0] <= 200  # ranges of some 100 rows
    plain = rolling_avg(df, "k", ["t", "id"], "v", -5, -1, "r")
    split = rolling_avg(df, "k", ["t", "id"], "v", -5, -1, "r", range_rows=100)
    assert rows(split) == rows(plain)
    # one long search: more bounds than a stride, ranges shorter than the look-back
    tiny = rolling_avg(df.filter("k = 0"), "k", ["t", "id"], "v", -5, -1, "r", range_rows=3)
    assert rows(tiny) == rows(plain.filter("k = 0"))


def test_prefix_scan_reads_and_shuffles_its_source_once(spark):
    import contextlib
    import io
    import tempfile

    path = tempfile.mkdtemp() + "/t"
    _random_frame(spark, 5).write.parquet(path)
    df = spark.read.parquet(path).withColumn("n", F.col("id") % 17)
    for out in (
        rolling_avg(df, "k", ["t", "id"], "v", -5, -1, "r", scale=2, range_rows=50),
        running_sum(df, "k", ["t", "id"], "n", "r", range_rows=50),
    ):
        text = io.StringIO()
        with contextlib.redirect_stdout(text):
            out.explain()
        plan = text.getvalue()
        assert plan.count("FileScan") == 1 and path in plan
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("Exchange") <= 3


def test_prefix_scan_stores_a_computed_source(spark):
    df = _random_frame(spark, 6).groupBy("k", "t").agg(F.min("id").alias("id"), F.max("v").alias("v"))
    out = rolling_avg(df, "k", ["t", "id"], "v", -5, -1, "r", scale=2, range_rows=50)
    assert "tidemark-" in "".join(out.inputFiles())
    assert rows(out) == rows(rolling_avg(df, "k", ["t", "id"], "v", -5, -1, "r", scale=2))


def test_prefix_scan_of_odd_keys(spark):
    import datetime
    import decimal

    kinds = {"binary": lambda i: bytes([i % 2]), "double": lambda i: float("nan") if i % 2 else None, "date": lambda i: datetime.date(2024, 1, 1 + i % 2)}
    for kind, make in kinds.items():
        data = [(make(i), decimal.Decimal(i % 9), None if i % 5 == 0 else i) for i in range(120)]
        df = spark.createDataFrame(data, f"k {kind}, t decimal(9,2), v INT").withColumn("id", F.monotonically_increasing_id())
        for fn in (lambda **kw: rolling_avg(df, "k", ["t", "id"], "v", -3, -1, "r", scale=0, **kw), lambda **kw: running_sum(df, "k", ["t", "id"], "v", "r", **kw)):
            assert sorted(map(str, fn(range_rows=10).collect())) == sorted(map(str, fn().collect()))


def test_future_guard_on_summary(spark):
    import pytest

    from tidemark.errors import FutureDateError

    df = spark.createDataFrame([(1, d(2026, 12, 25), d(9999, 12, 31))], S)
    with pytest.raises(FutureDateError):
        compute_player_injury_summary(df, current_processing_date=d(2026, 5, 17), guard_future=True)
