"""Registered queries: each operator on the test tables, with the same question in SQL where SQL can ask it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def r6(c: str | Column, digits: int = 6) -> Column:
    """Rounded for comparison: the nudge settles exact halves, adding zero removes a negative zero."""
    column = F.col(c) if isinstance(c, str) else c
    return F.round(column + F.lit(2e-9), digits) + F.lit(0.0)


def s6(expr: str, digits: int = 6) -> str:
    """`r6` in SQL."""
    return f"(round(({expr}) + CAST(2e-9 AS DOUBLE), {digits}) + CAST(0 AS DOUBLE))"


def load_all() -> None:
    from tidemark.registry import aggregates, analytics, columns, joins, scalars, tables, windows  # noqa: F401
