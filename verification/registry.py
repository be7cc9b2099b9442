"""Registered queries, each with the SQL it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseloom.plans.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def add(name: str, run: Query, sql: str | None = None) -> None:
    """Register a query; it runs with the library's session settings."""
    assert name not in QUERIES, name

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(apply_settings(spark), sf_dir)

    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql
