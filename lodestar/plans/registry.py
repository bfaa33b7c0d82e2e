"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where SQL can express it, the equivalent DuckDB SQL over the same tables.

Every registered query reads whole tables; doubles are rounded to ``DIGITS``
decimals on both sides so the two engines hash equal values.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from lodestar.session import ship_package

DIGITS = 6

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOTES: dict[str, str] = {}


def register(name: str, sql: str | None = None, note: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)     # Python functions in tasks import this package
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        if note:
            NOTES[name] = note
        return fn
    return deco
