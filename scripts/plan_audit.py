"""Audit the physical plan of every registered query: flag cross products
(CartesianProduct, BroadcastNestedLoopJoin) and Python evaluation nodes,
and list how many columns each parquet scan reads.

usage: python scripts/plan_audit.py [sf_dir] [--all]
Iterative jobs run actions while their plan is built; they are skipped
unless --all is given."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestar.session import build_session  # noqa: E402
from lodestar.plans.registry import all_queries  # noqa: E402

ITERATIVE = {"crawl_bfs", "crawl_budget", "crawl_index", "tree_nodes", "tree_describe", "tree_predict"}
FLAGS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    everything = "--all" in sys.argv
    spark = build_session("local[8]", 8)
    bad = 0
    for name, fn in sorted(all_queries().items()):
        if name in ITERATIVE and not everything:
            continue
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        flags = [k for k in FLAGS if k in plan]
        widths = [s.count(",") + 1 for s in re.findall(r"FileScan parquet [^\[]*\[([^\]]*)\]", plan)]
        bad += bool(flags)
        print(f"{name:26s} flags={flags} scan_widths={sorted(set(widths))}")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
