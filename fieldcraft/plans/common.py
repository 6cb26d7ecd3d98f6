"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldcraft.sources import fixtures as fx

KEEP = ["row_id", "split"]


def is_train():
    """Training rows of the fixture (a Column, built when a session exists)."""
    return F.col("split") == F.lit("train")


def round_doubles(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double/float column for a stable comparison."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name).cast("double"), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def merged(spark, d):
    return fx.merged(spark, d)


def log(spark, d):
    return fx.log(spark, d)


def psi_sql(x: str) -> str:
    """Digamma as a SQL expression (same series as functions.numeric.digamma)."""
    y = f"(({x}) + 6.0)"
    shift = " + ".join(f"1.0/(({x}) + {i}.0)" for i in range(6))
    return (f"(ln({y}) - 0.5/{y} - 1.0/(12.0*{y}*{y}) + 1.0/(120.0*{y}*{y}*{y}*{y})"
            f" - 1.0/(252.0*{y}*{y}*{y}*{y}*{y}*{y}) - ({shift}))")


def fpi_sql(hist: str, group: str | None, iters: int = 1000, eps: float = 1e-3,
            a0: float = 1.0, b0: float = 1.0) -> str:
    """Subquery that iterates the fixed point over ``hist(group, n, s, m)`` until
    it stops: columns ``group`` (if any), ``a``, ``b``."""
    g = group or "0"
    den = f"sum(h.m*({psi_sql('h.n + p.a + p.b')} - {psi_sql('p.a + p.b')}))"
    na = f"sum(h.m*({psi_sql('h.s + p.a')} - {psi_sql('p.a')}))"
    nb = f"sum(h.m*({psi_sql('h.n - h.s + p.b')} - {psi_sql('p.b')}))"
    stop = (f"(na IS NULL OR nb IS NULL OR NOT isfinite(na) OR NOT isfinite(nb) OR na <= 0 OR nb <= 0 "
            f"OR (abs(na - a) < {eps} AND abs(nb - b) < {eps}))")
    return f"""(WITH RECURSIVE hh AS MATERIALIZED (SELECT {g} AS g, n, s, m FROM {hist}),
p AS (
  SELECT DISTINCT g, 0 AS it, {a0}::DOUBLE AS a, {b0}::DOUBLE AS b, false AS done FROM hh
  UNION ALL
  SELECT g, it + 1, CASE WHEN {stop} THEN a ELSE na END, CASE WHEN {stop} THEN b ELSE nb END, {stop}
  FROM (SELECT p.g, p.it, p.a, p.b, p.a*{na}/nullif({den}, 0) AS na, p.b*{nb}/nullif({den}, 0) AS nb
        FROM p JOIN hh h ON h.g = p.g WHERE NOT p.done AND p.it < {iters} GROUP BY p.g, p.it, p.a, p.b) x)
SELECT g{f' AS {group}' if group else ''}, arg_max(a, it) AS a, arg_max(b, it) AS b FROM p GROUP BY g)"""
