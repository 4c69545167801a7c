"""Where the catalogue modules put their queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkcdc.plans.fixtures import with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None, uses: str = ""):
    """Register ``fn(spark, folder)``; ``uses`` names the derived inputs its SQL needs."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_sql(uses, sql)
        return fn

    return add
