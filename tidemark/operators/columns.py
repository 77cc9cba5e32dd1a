"""Column selection by list, by presence and by type, and the rows of a group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_required(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The given columns in sorted order; a missing one is an error."""
    wanted = sorted(set(columns))
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*wanted)


def select_available(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Those of the given columns that exist, in the given order."""
    return df.select(*[c for c in columns if c in df.columns])


def drop_missing_metric(df: DataFrame, metric: str) -> DataFrame:
    return df.dropna(subset=[metric])


def rows_of_group(df: DataFrame, segment: str, group: str) -> DataFrame:
    return df.where(F.col(segment) == F.lit(group))
