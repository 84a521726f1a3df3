"""Plan-shape guards: no cartesian products, nested-loop joins or Python row evaluation."""

import pytest

from lapse.queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
NAMES = [n for n in QUERIES if not n.startswith(("p8", "p9"))]  # k-means: Spark ML, checked elsewhere


@pytest.mark.parametrize("name", NAMES)
def test_plan_has_no_pair_explosion_or_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [f for f in FORBIDDEN if f in plan]


@pytest.mark.parametrize("name", ["s1_plan_health", "s2_ltv_rank", "p1_customer_base", "op_latest_per_group", "m1_session_cadence_by_plan"])
def test_first_rows_need_no_sort_aggregate(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan
