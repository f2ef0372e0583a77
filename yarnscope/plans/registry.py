"""All named plans and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import classify_plans, log_plans, report_plans, workload_plans

_MODULES = [workload_plans, log_plans, classify_plans, report_plans]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict = {}
    for m in _MODULES:
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict[str, str]:
    out: dict = {}
    for m in _MODULES:
        out.update(m.ORACLE)
    return out
