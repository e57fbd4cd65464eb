"""All registered queries."""
from __future__ import annotations

import importlib

from sparkpack.plans.registry import CHECKS, QUERIES

for _module in (
    "intake_queries", "function_queries", "packing_queries", "outcome_queries", "metric_queries", "stream_queries", "delivery",
):
    importlib.import_module(f"sparkpack.plans.{_module}")


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(CHECKS)
