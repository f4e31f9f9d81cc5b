"""All registered queries and their DuckDB oracles, gathered from the plan
modules of the four jobs."""

from __future__ import annotations

import importlib

PLAN_MODULES = (
    "lodestar.plans.search_plans",
    "lodestar.plans.index_plans",
    "lodestar.plans.diff_plans",
    "lodestar.plans.tree_plans",
    "lodestar.plans.linkage_plans",
    "lodestar.plans.links_plans",
    "lodestar.plans.warmup_plans",
    "lodestar.plans.io_plans",
)


def _modules():
    return [importlib.import_module(m) for m in PLAN_MODULES]


def all_queries() -> dict:
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def all_oracles() -> dict:
    out = {}
    for m in _modules():
        out.update(m.ORACLE)
    return out
