"""Plan guards for every registered query of the catalog (sf0.001)."""

import os
import re

import pytest

SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInArrow", "MapInPandas")


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
def test_no_cross_joins_or_python_in_any_plan(spark):
    from tidemark.plans.catalog import QUERIES

    bad = {}
    for name, fn in QUERIES.items():
        plan = fn(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        hits = [k for k in FORBIDDEN if k in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


@pytest.mark.skipif(not os.path.exists(SMALL), reason="driver tables not present")
def test_scans_are_pruned_and_filtered(spark):
    import __spark_entry__ as E

    plan = E.queries()["lookback_baseline"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("l_comment" not in s and "l_tax" not in s for s in schemas)
    plan = E.queries()["scd2_apply"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    plan = E.queries()["player_stats"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_" in plan
