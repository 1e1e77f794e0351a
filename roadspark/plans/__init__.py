"""Registered queries and, where SQL can express them, their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadspark.plans import eda, features, marts, models, quality, ranking, sources

_MODULES = (sources, quality, eda, features, marts, ranking, models)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: run for module in _MODULES for name, run in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
