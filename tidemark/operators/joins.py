"""Joins of the two fact loads. Dimensions are cut to the rows and columns in use before they are joined.

No side is forced to broadcast: Spark broadcasts a dimension by its measured size, and adaptive execution
splits skewed partitions of the fact side otherwise. Facts without a key cannot match; a second key spreads them over
all tasks, where the null alone would send them to one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import within_period


def spread_nulls(facts: DataFrame, side: DataFrame, pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Join condition on the pairs (fact key, dimension key), with rows of a null fact key dealt out by their content."""
    missing = reduce(Column.__or__, [fact.isNull() for fact, _ in pairs])
    salt = F.when(missing, F.xxhash64(*[facts[c] for c in facts.columns])).otherwise(F.lit(0).cast("long"))
    # Always 0; written so that the planner keeps it as a key.
    zero = F.pmod(F.xxhash64(*[key for _, key in pairs]), F.lit(1)).cast("long")
    return reduce(Column.__and__, [fact == key for fact, key in pairs], salt == zero)


def version_covering(dim: DataFrame, start: date, end: date, valid_from: str = "start_date", valid_to: str = "end_date") -> DataFrame:
    """Rows of a history dimension whose version covers the whole period."""
    return dim.where((F.col(valid_from) <= F.lit(start)) & (F.col(valid_to) > F.lit(end)))


def valid_as_of(dim: DataFrame, as_of: date | datetime | Column | None = None, valid_to: str = "end_date") -> DataFrame:
    """Rows still valid at `as_of`, by default now."""
    moment = F.current_timestamp() if as_of is None else as_of if isinstance(as_of, Column) else F.lit(as_of)
    return dim.where(F.col(valid_to) > moment)


def join_history(
    facts: DataFrame, dim: DataFrame, keys: Sequence[tuple[str, str]], start: date, end: date, columns: Sequence[str]
) -> DataFrame:
    """Left join to the version covering the period; several matching versions multiply rows."""
    side = version_covering(dim, start, end).select(
        *[F.col(k).alias(f"_k{i}") for i, (_, k) in enumerate(keys)], *columns
    )
    on = spread_nulls(facts, side, [(facts[f], side[f"_k{i}"]) for i, (f, _) in enumerate(keys)])
    return facts.join(side, on, "left").drop(*[f"_k{i}" for i in range(len(keys))])


def join_snapshot(
    facts: DataFrame,
    snapshot: DataFrame,
    key: str,
    ts: str,
    start: date,
    end: date,
    columns: Sequence[str],
    snap_day: str = "snap_date",
) -> DataFrame:
    """Left join to a daily snapshot on (key, day of the event), the snapshot cut to the period."""
    side = snapshot.where(within_period(snap_day, start, end)).select(
        F.col(key).alias("_key"), F.to_date(snap_day).alias("_day"), *columns
    )
    on = spread_nulls(facts, side, [(facts[key], side["_key"]), (F.to_date(facts[ts]), side["_day"])])
    return facts.join(side, on, "left").drop("_key", "_day")


def join_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, columns: Sequence[str]) -> DataFrame:
    """Left lookup in a dimension; null keys stay unmatched."""
    side = dim.select(F.col(dim_key).alias("_key"), *columns)
    return df.join(side, spread_nulls(df, side, [(df[key], side["_key"])]), "left").drop("_key")


def join_months_apart(
    left: DataFrame, right: DataFrame, key: str, left_month: str, right_month: str, delta: int
) -> DataFrame:
    """Inner join on (key, month of the left row shifted by `delta` months)."""
    shifted = F.add_months(left[left_month], delta)
    return left.join(right, (left[key] == right[key]) & (shifted == right[right_month])).drop(right[key])
