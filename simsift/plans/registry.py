"""Registry of named queries over the driver test tables.

Each entry pairs a Spark builder ``fn(spark, sf_dir) -> DataFrame`` with, where
SQL can express it, an equivalent DuckDB query over the pre-registered views.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---- DuckDB expression helpers (mirror simsift.functions.vectors exactly) ----

def sql_dot(a: str, b: str) -> str:
    return (f"list_reduce(list_transform(range(1, len({a}) + 1), "
            f"lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE), lambda x, y: x + y, 0.0::DOUBLE)")


def sql_norm(a: str) -> str:
    return (f"sqrt(list_reduce(list_transform({a}, lambda x: x::DOUBLE * x::DOUBLE), "
            f"lambda x, y: x + y, 0.0::DOUBLE))")


def sql_cosine(a: str, b: str) -> str:
    den = f"({sql_norm(a)} * {sql_norm(b)})"
    return f"(CASE WHEN {den} = 0 THEN NULL ELSE {sql_dot(a, b)} / {den} END)"


def sql_score(a: str, b: str, metric: str = "cosine") -> str:
    inner = sql_cosine(a, b) if metric == "cosine" else sql_dot(a, b)
    return f"round({inner}, 6)"
