"""Name -> Spark query, and name -> SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mortar.plans.frames import Frames
from mortar.session import small_methods

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(name: str, build: Callable[[Frames], DataFrame], sql: str | None = None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_methods(spark)
        return build(Frames(spark, sf_dir))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        SQL[name] = sql


def load() -> None:
    """Import the modules that register queries."""
    from mortar.plans import capital, history, loans, reports, staging  # noqa: F401
