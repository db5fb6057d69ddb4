import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tidemark.errors import SourceMissingError
from tidemark.sources.io import publish_version, read_latest, read_source, write_partitioned


def test_missing_source_is_typed(spark, scratch):
    with pytest.raises(SourceMissingError):
        read_source(spark, os.path.join(scratch, "nope.parquet"))
    with pytest.raises(FileNotFoundError):
        read_source(spark, os.path.join(scratch, "nope.parquet"))


def test_dynamic_partition_overwrite_is_rerun_stable(spark, scratch):
    path = os.path.join(scratch, "fact")
    day1 = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01")], "v INT, snapshot_date STRING")
    day2 = spark.createDataFrame([(3, "2024-01-02")], "v INT, snapshot_date STRING")
    write_partitioned(day1, path, ["snapshot_date"])
    write_partitioned(day2, path, ["snapshot_date"])
    write_partitioned(day2, path, ["snapshot_date"])  # rerun replaces, does not append
    assert rows(spark.read.parquet(path), "v") == [(1,), (2,), (3,)]


def test_versioned_publish(spark, scratch):
    base = os.path.join(scratch, "dim")
    assert read_latest(spark, base) is None
    publish_version(spark.createDataFrame([(1,)], "k INT"), base)
    cur = read_latest(spark, base)
    publish_version(cur.withColumn("k", F.col("k") + 1), base)  # reads v=0, writes v=1
    assert rows(read_latest(spark, base)) == [(2,)]


SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
def test_registered_queries_match_oracle_sf0001(spark):
    from oracle_compare import compare

    from tidemark.plans.catalog import ORACLE_SQL

    res = compare(spark, SMALL, sorted(ORACLE_SQL), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] is False}
    assert not bad, bad


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E

    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_bucketed_tables_join_without_shuffle(spark):
    from tidemark.sources.io import save_table

    shots = spark.range(0, 2000).select((F.col("id") % 97).alias("match_id"), (F.col("id") / 1000).alias("xg"))
    roster = spark.range(0, 500).select((F.col("id") % 97).alias("match_id"), F.col("id").alias("player_id"))
    save_table(shots, "bk_shots", bucket_by=(8, "match_id"))
    save_table(roster, "bk_roster", bucket_by=(8, "match_id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("bk_shots").join(spark.table("bk_roster"), "match_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        assert j.count() > 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_incomplete_version_is_invisible(spark, scratch):
    base = os.path.join(scratch, "dim2")
    publish_version(spark.createDataFrame([(1,)], "k INT"), base)
    # a crashed writer leaves a folder without its _SUCCESS marker
    spark.createDataFrame([(99,)], "k INT").write.parquet(os.path.join(base, "v=7"))
    os.remove(os.path.join(base, "v=7", "_SUCCESS"))
    assert rows(read_latest(spark, base)) == [(1,)]
    publish_version(spark.createDataFrame([(2,)], "k INT"), base)  # skips the broken v=7
    assert rows(read_latest(spark, base)) == [(2,)]


def test_catalog_reads_views_and_guard(spark):
    from tidemark.sources.io import create_namespace, read_table, register_views, run_view_script

    create_namespace(spark, "tidemark_io_ns")
    create_namespace(spark, "tidemark_io_ns")  # idempotent
    with pytest.raises(SourceMissingError):
        read_table(spark, "tidemark_io_ns.absent_table")
    register_views(spark, {"v_base": spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")})
    run_view_script(spark, ["CREATE OR REPLACE TEMP VIEW v_top AS SELECT k FROM v_base WHERE k > 1;", "  "])
    assert rows(read_table(spark, "v_top")) == [(2,)]
