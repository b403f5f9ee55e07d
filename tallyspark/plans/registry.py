"""All queries of the core, by name, and the SQL of those that have one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyspark.plans import core_problems, q_measures, q_reports, q_text, q_trends, q_versions

MODULES = [core_problems, q_versions, q_measures, q_trends, q_text, q_reports]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLE.items()}
