"""Physical plans of the registered queries: no cross products and no
Python evaluation nodes (the iterative jobs are covered by their own
tests and skipped here, since building them runs their loops)."""

import pytest

from lodestar.plans.registry import all_queries

ITERATIVE = {"crawl_bfs", "crawl_budget", "crawl_index", "tree_nodes", "tree_describe", "tree_predict"}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(set(all_queries()) - ITERATIVE))
def test_plan_has_no_cross_product_or_python(spark, sf_small, name):
    plan = all_queries()[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert [k for k in FORBIDDEN if k in plan] == []
