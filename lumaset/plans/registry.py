"""Registered queries and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str):
    """Register a function under its name, with its SQL."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def big(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]
