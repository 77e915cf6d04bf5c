"""Registered queries: each pairs a Spark plan with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a plan, with the SQL that yields the same rows where there is one."""
    def keep(plan: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = plan
        if sql is not None:
            SQL[name] = sql.strip()
        return plan
    return keep
