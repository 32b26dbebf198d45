"""All registered queries of the library with their SQL oracles, gathered from the query modules."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES: tuple[str, ...] = ("search", "duplicates", "corpus", "selection", "ledger", "reports", "measures", "reading", "patches", "runs", "composed", "evaluation")

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {k: f for m in MODULES for k, (f, _) in import_module(f"foliospark.plans.{m}").QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: sql for m in MODULES for k, (_, sql) in import_module(f"foliospark.plans.{m}").QUERIES.items() if sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return next(iter(queries().values()))(spark, sf_dir)
