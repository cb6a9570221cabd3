"""Registry of runnable queries, each next to the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tierflow.functions.scalars import clock_free

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function (spark, folder of the tables) -> DataFrame under its own or the given name."""

    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, root: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return clock_free(build(spark, root.rstrip("/")))

        key = name or build.__name__
        QUERIES[key] = run
        if sql:
            SQL[key] = sql
        return run

    return register
