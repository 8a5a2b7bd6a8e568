"""Name → Spark query, name → SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, *parts: str, sql: str | None = None, recursive: bool = False):
    """Register a query; ``parts`` are the common table expressions its SQL reads."""

    def register(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            kind = "WITH RECURSIVE" if recursive else "WITH"
            ORACLES[name] = f"{kind} {', '.join(parts)} {sql}" if parts else sql
        return query

    return register


def cut(e: str) -> str:
    """SQL text: a sum or average to 4 decimals.

    Such values depend on the order of addition in their last bits, and the two engines break
    decimal ties differently; the odd offset keeps short decimals off the boundary.
    """
    return f"floor(({e}) * 10000 + 0.4321) / 10000"


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """The same in Spark."""
    return df.withColumns({c: F.floor(F.col(c) * 10000 + 0.4321) / 10000 for c in cols})
