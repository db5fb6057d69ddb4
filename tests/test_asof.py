import datetime as dt

from conftest import rows
from tidemark.operators.asof import asof_join, inside_closed

d = dt.date
DIM = "k INT, st STRING, valid_from DATE, valid_to DATE"
FACT = "fid INT, k INT, day DATE"


def _brute(facts, dims, open_end=None):
    out = []
    for fid, k, day in facts:
        for dk, st, vf, vt in dims:
            is_open = vt is None or (open_end is not None and vt >= open_end)
            if dk == k and day >= vf and (is_open or day < vt):
                out.append((fid, k, day, st))
    return sorted(out)


def test_half_open_bounds_gaps_and_open_versions(spark):
    dims = [
        (1, "a", d(2024, 1, 1), d(2024, 1, 10)),
        (1, "b", d(2024, 1, 10), d(2024, 3, 5)),  # spans three months
        (1, "c", d(2024, 3, 20), None),  # gap before, open after
        (2, "x", d(2023, 12, 31), d(9999, 12, 31)),  # sentinel open end
        (3, "z", d(2024, 1, 5), d(2024, 1, 5)),  # zero length: never matches
    ]
    facts = [
        (1, 1, d(2023, 12, 31)), (2, 1, d(2024, 1, 1)), (3, 1, d(2024, 1, 9)), (4, 1, d(2024, 1, 10)),
        (5, 1, d(2024, 2, 15)), (6, 1, d(2024, 3, 5)), (7, 1, d(2024, 3, 20)), (8, 1, d(2025, 6, 1)),
        (9, 2, d(2024, 7, 1)), (10, 3, d(2024, 1, 5)), (11, 4, d(2024, 1, 5)),
    ]
    fd = spark.createDataFrame(facts, FACT)
    dd = spark.createDataFrame(dims, DIM)
    got = rows(asof_join(fd, dd, ["k"], "day", open_end=d(9999, 12, 31)), "fid", "k", "day", "st")
    assert got == _brute(facts, dims, d(9999, 12, 31))
    assert [r[0] for r in got] == [2, 3, 4, 5, 7, 8, 9]
    # an explicit horizon before a fact's month bounds the buckets, not the facts
    capped = rows(asof_join(fd, dd, ["k"], "day", open_end=d(9999, 12, 31), horizon=d(2024, 12, 1)), "fid", "k", "day", "st")
    assert capped == got


def test_inside_closed(spark):
    dims = spark.createDataFrame([(1, "a", d(2024, 1, 1), d(2024, 2, 1)), (1, "b", d(2024, 2, 1), None)], DIM)
    ev = spark.createDataFrame([(1, 1, d(2024, 1, 15)), (2, 1, d(2024, 2, 15)), (3, 1, d(2024, 2, 1))], FACT)
    assert rows(inside_closed(ev, dims, ["k"], "day"), "fid") == [(1,)]


def test_grains_agree(spark):
    dims = [(1, "a", d(2023, 11, 20), d(2024, 2, 3)), (1, "b", d(2024, 2, 3), None), (2, "c", d(2024, 1, 1), d(2024, 1, 2))]
    facts = [(i, 1 + i % 2, d(2023, 11, 1) + dt.timedelta(days=7 * i)) for i in range(40)]
    fd = spark.createDataFrame(facts, FACT)
    dd = spark.createDataFrame(dims, DIM)
    expected = _brute(facts, dims)
    for grain in ("month", "quarter", "year"):
        assert rows(asof_join(fd, dd, ["k"], "day", grain=grain), "fid", "k", "day", "st") == expected
