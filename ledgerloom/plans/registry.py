"""Named queries: a function ``(spark, folder) -> DataFrame`` and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def named(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return register


def r(c: Column | str, digits: int = 6) -> Column:
    """Rounded half up for comparison, in plain double arithmetic."""
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10**digits)
    return F.floor(c.cast("double") * scale + 0.5) / scale


def R(expression: str, digits: int = 6) -> str:
    """The same rounding in SQL, without a negative zero."""
    scale = f"{10**digits}.0::DOUBLE"
    return f"(floor(CAST({expression} AS DOUBLE) * {scale} + 0.5) / {scale} + 0.0)"
