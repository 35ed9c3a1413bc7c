"""Registry of named queries: each is ``(spark, sf_dir) -> DataFrame`` plus,
where the operator is SQL-expressible, its DuckDB oracle text.

Every query reads the driver tables of ``sf_dir`` (or tables Spark derives from
them), so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from terracheck.plans import queries_core, queries_dirty, queries_inject, queries_ml, queries_report, queries_rules, queries_runs, queries_suite  # noqa: F401
