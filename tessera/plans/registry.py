"""Key -> (Spark query, oracle SQL) registry.

A query is ``fn(spark, sf_dir) -> DataFrame`` over the shared tables. The oracle
is SQL for an independent engine (DuckDB) over the same tables registered as
views; keys without one are checked by rows and properties only.

Conventions shared by both sides: floats rounded to 6 digits, counts as BIGINT,
vectors exploded to ``(id, pos, value)`` rows, lists rendered as strings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Fixed value: digits kept for every floating-point result.
DIGITS = 6


def register(key: str, sql: str | None = None):
    """Decorator: register ``fn`` as query ``key`` with an optional oracle."""

    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return deco
