"""Registry of named queries and their oracle SQL.

Every query is a callable ``(spark, sf_dir) -> DataFrame`` over the test
tables. Its oracle is the same result written as SQL for an independent
engine (the adapter views are inlined, see ``sql_views``); queries that
have no SQL form register without one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register
