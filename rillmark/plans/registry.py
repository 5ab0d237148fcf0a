"""Where the families register their queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def r(c: Column | str, digits: int = 6) -> Column:
    """Round for comparison with the other engine."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: r(n, digits) for n in names})


def rsql(expr: str, digits: int = 6) -> str:
    """The same in SQL; adding zero turns a negative zero into zero."""
    return f"(round({expr}, {digits}) + 0e0)"
