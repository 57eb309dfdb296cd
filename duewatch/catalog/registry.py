"""Named queries and the SQL each one is checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from duewatch.catalog.inputs import Inputs
from duewatch.catalog.views import check_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(sql: str | None = None, **extra_views: str):
    """Register a function of ``Inputs`` under its own name, with the SQL for DuckDB if there is one."""

    def register(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        name = build.__name__
        QUERIES[name] = lambda spark, folder: build(Inputs(spark, folder))
        if sql is not None:
            CHECKS[name] = check_sql(sql, extra_views)
        return build

    return register
