"""The detector over a stored state: a reload of a period reads the facts of that period only.

State: mergeable sums (segment, group, day, n_rows, n_values, total, least, most), by month, and the scored series, by
bucket of groups. A reload replaces the sums of its days, scores again the groups that had or have rows in the
period, and makes both current in one commit. Contributions and winners follow from the two tables when they are read: the change
of the whole table moves with every reload, the series of a group only with its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import within_period
from tidemark.functions.scalars import nan_to_null
from tidemark.operators.segments import to_long
from tidemark.plans.detector import SERIES, WHOLE, SegmentAnomalies, base_series, contributions, result_tables, score_series
from tidemark.session import settled
from tidemark.sources.versions import Staged, Store, month_chunk, months_of, period_staged

SUMS, SCORED = "sums", "scored"
BUCKETS = 64

#: The metric of a day from its sums.
FROM_SUMS = {
    "mean": lambda: F.try_divide(F.col("total"), F.col("n_values")),
    "sum": lambda: F.when(F.col("n_values") > 0, F.col("total")),
    "size": lambda: F.col("n_rows"),
    "count": lambda: F.col("n_values"),
    "min": lambda: F.col("least"),
    "max": lambda: F.col("most"),
}


def partial_sums(df: DataFrame, day: str, metric: str, segments: Sequence[str]) -> DataFrame:
    """(segment, group, day, n_rows, n_values, total, least, most) of all groups and of the whole table, from one scan."""
    value = nan_to_null(F.col(metric).cast("double"))
    source = df.select(F.col(day).alias("day"), value.alias("_metric"), *segments).withColumn(WHOLE, F.lit("all"))
    long = to_long(source, "day", "_metric", [*segments, WHOLE])
    return long.groupBy(*SERIES, "day").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("_metric").alias("n_values"),
        F.sum("_metric").alias("total"),
        F.min("_metric").alias("least"),
        F.max("_metric").alias("most"),
    )


def merged_sums(sums: DataFrame) -> DataFrame:
    """Sums of several parts of the facts as those of all of them."""
    return sums.groupBy(*SERIES, "day").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_values", "total")], F.min("least").alias("least"), F.max("most").alias("most")
    )


def daily_of_sums(sums: DataFrame, func: str) -> DataFrame:
    if func not in FROM_SUMS:
        raise ValueError(f"{func!r} does not follow from sums; known: {sorted(FROM_SUMS)}")
    return sums.select(*SERIES, "day", FROM_SUMS[func]().alias("metric"), "n_rows", "n_values")


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*SERIES), F.lit(BUCKETS)).cast("string")


def start_detector(
    store: Store, df: DataFrame, segments: Sequence[str], day: str = "snap_date_day", metric: str = "nps", func: str = "mean", **options
) -> int:
    """First state of a store, from all facts; `options` are those of `score_series`."""
    based_on = store.version()
    sums = settled(partial_sums(df, day, metric, segments))
    staged = store.stage(sums, month_chunk("day"))
    scored = store.stage(score_series(daily_of_sums(sums, func), **options), _bucket())
    return store.commit({SUMS: staged, SCORED: scored}, based_on)


def reload_detector(
    store: Store,
    facts: DataFrame,
    start: date,
    end: date,
    segments: Sequence[str],
    day: str = "snap_date_day",
    metric: str = "nps",
    func: str = "mean",
    **options,
) -> int:
    """Replace the facts of the half-open period [start, end) by those of `facts` in it; of the source only these are read.

    The other days come from the stored sums, one row for each group and day. Days of the period without facts end up
    empty, and groups without any row leave the scored table.
    """
    based_on = store.version()
    fresh = settled(partial_sums(facts.where(within_period(day, start, end)), day, metric, segments))
    staged = period_staged(store, SUMS, fresh, start, end, "day")
    inside = within_period("day", start, end)
    before = store.read(SUMS, months_of(start, end)).where(inside)
    touched = settled(before.select(*SERIES).union(fresh.select(*SERIES)).distinct().where(F.col("segment") != WHOLE))
    outside = store.read(SUMS).where(~inside)
    series = outside.unionByName(fresh).join(touched, SERIES, "left_semi")
    again = score_series(daily_of_sums(series, func), **options)
    # At most BUCKETS numbers.
    buckets = [r[0] for r in touched.select(_bucket()).distinct().collect()]
    others = store.read(SCORED, buckets).join(touched, SERIES, "left_anti")
    scored = store.stage(others.unionByName(again), _bucket(), buckets) if buckets else Staged(others.schema.json(), {})
    return store.commit({SUMS: staged, SCORED: scored}, based_on)


def stored_anomalies(
    store: Store, segments: Sequence[str], func: str = "mean", z_threshold: float = 3.0, winner: str = "contribution", clip_contributions: bool = True
) -> SegmentAnomalies:
    """The detector's tables from the current version; no facts are read."""
    base = base_series(daily_of_sums(store.read(SUMS).where(F.col("segment") == WHOLE), func))
    return result_tables(contributions(store.read(SCORED), base, clip_contributions), base, segments, z_threshold, winner)
