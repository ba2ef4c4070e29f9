"""Registry of named queries: a Spark plan builder and its DuckDB oracle SQL.

Every registered query reads the driver tables (through the adapters) so its
work grows with the scale factor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` (and its oracle SQL)."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # all timestamps in the data model are UTC instants
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def ctes(**parts: str) -> str:
    """``WITH a AS (...), b AS (...)`` in keyword order."""
    return "WITH " + ",\n".join(f"{k} AS (\n{v}\n)" for k, v in parts.items()) + "\n"


def load_all() -> None:
    # importing the plan modules fills the registry
    from . import (compare, features, governance, investigation, models,  # noqa: F401
                   monitoring, performance, profiling, scoring, sources, streaming)
