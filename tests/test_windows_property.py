"""Property test: the hot-key window path equals the plain window, NULLs everywhere."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tidemark.operators.windows import rolling_avg, running_sum

row = st.tuples(
    st.one_of(st.none(), st.integers(0, 2)),  # key (few keys -> hot ones)
    st.one_of(st.none(), st.integers(0, 400)),  # order value
    st.one_of(st.none(), st.integers(0, 999).map(lambda c: c / 100)),  # 2-decimal value
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(row, min_size=1, max_size=120),
    lo=st.integers(-6, -1),
    width=st.integers(1, 50),
    scale=st.sampled_from([2, None]),
)
def test_split_equals_plain(spark, data, lo, width, scale):
    df = spark.createDataFrame([(k, i, t, v) for i, (k, t, v) in enumerate(data)], "k INT, id INT, t INT, v DOUBLE")
    hi = min(0, lo + 2)
    plain = rolling_avg(df, "k", ["t", "id"], "v", lo, hi, "r", scale=scale)
    split = rolling_avg(df, "k", ["t", "id"], "v", lo, hi, "r", scale=scale, range_rows=width)
    assert rows(split) == rows(plain)
    sums = df.withColumn("n", (F.col("v") * 100).cast("int"))
    for value in ("n", "d"):
        sums = sums.withColumn("d", F.col("v").cast("decimal(9,2)"))
        assert rows(running_sum(sums, "k", ["t", "id"], value, "c", range_rows=width)) == rows(
            running_sum(sums, "k", ["t", "id"], value, "c")
        )
