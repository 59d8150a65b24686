"""Name → (Spark query, SQL oracle)."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from chatloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = shipped
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
