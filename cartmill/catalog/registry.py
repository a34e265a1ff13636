"""Where catalogue modules register a query and its equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cartmill.catalog.shop import Shop
from cartmill.session import apply_semantics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the bound tables under ``name``."""

    def register(build: Callable[[Shop], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Shop(apply_semantics(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
