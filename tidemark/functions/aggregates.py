"""Aggregates by name. All of them combine on the map side, so a hot day or group shrinks before the shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "size": lambda c: F.count(F.lit(1)),
    "count": F.count,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "nunique": F.count_distinct,
}


def aggregate(func: str | Callable[[Column], Column], c: str | Column) -> Column:
    """Aggregate by name or by a builder that takes the column. `median` needs `operators.quantiles`."""
    column = F.col(c) if isinstance(c, str) else c
    if callable(func):
        return func(column)
    if func not in AGGREGATES:
        raise ValueError(f"unknown aggregate {func!r}; known: {sorted(AGGREGATES)} and 'median'")
    return AGGREGATES[func](column)
