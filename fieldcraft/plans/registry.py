"""Registered queries: key -> Spark callable (spark, sf_dir) -> DataFrame,
and key -> SQL oracle (DuckDB, driver tables as views)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldcraft.plans.oracle_base import q

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    """Register a query; ``sql`` is the body after the fixture CTE prefix."""
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = q(sql)
        return fn
    return deco
