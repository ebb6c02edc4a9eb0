"""Queries over the given tables, each with the SQL that states its expected result."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

MODULES = ("cohort", "privacy", "quality", "registry", "clinical", "files", "tiers")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name; without SQL it is tested on fixtures instead."""

    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return add


def load() -> None:
    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def undotted(df: DataFrame) -> DataFrame:
    """Column names without dots, so that results can be compared by plain names."""
    return df.toDF(*[name.replace(".", "__") for name in df.columns])
