"""Where queries are registered by name, each with the SQL that it is held against where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veritab.plans.views import sql, view

Load = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, oracle: str | None = None, *adapters: str) -> Callable:
    """Register a query that takes a loader of tables and adapters."""

    def add(build: Callable[[Load], DataFrame]) -> Callable[[Load], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(lambda table: view(spark, sf_dir, table))
        if oracle is not None:
            ORACLE_SQL[name] = sql(oracle, *adapters)
        return build

    return add
