"""All registered queries: name -> (spark, sf_dir) -> DataFrame, plus oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vitaldf.plans import q_files, q_functions, q_sources, q_tables  # noqa: F401  (registration)
from vitaldf.plans.registry import CATALOG, prepare


def _bind(fn) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark, sf_dir)
        return fn(spark)
    run.__name__ = getattr(fn, "__name__", "query")
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _bind(fn) for name, (fn, _) in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, (_, sql) in CATALOG.items() if sql is not None}
