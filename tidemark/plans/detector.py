"""Which segment group drives the change of a metric on each day."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import nan_to_null
from tidemark.operators.isolation import isolation_score
from tidemark.operators.segments import (
    group_daily,
    keep_large_groups,
    segment_columns,
    significant_groups,
    with_contribution,
)
from tidemark.operators.series import with_delta, with_rolling_score
from tidemark.session import settled
from tidemark.sources.sinks import write_detector, write_table

SERIES = ["segment", "group"]
#: The table as a segment of its own, with one group.
WHOLE = "__all__"


@dataclass(frozen=True)
class SegmentAnomalies:
    significant: DataFrame
    z_scores: DataFrame
    contributions: DataFrame
    scored: DataFrame
    base: DataFrame


def _known(df: DataFrame, day: str, metric: str, segments: Sequence[str]) -> DataFrame:
    """The columns in use, with NaN as null."""
    source = df.select(day, metric, *segments)
    if source.schema[metric].dataType.typeName() in ("double", "float"):
        source = source.withColumn(metric, nan_to_null(F.col(metric)))
    return source


def all_daily(
    df: DataFrame, day: str, metric: str, func: str | Callable[[Column], Column], segments: Sequence[str]
) -> DataFrame:
    """(segment, group, day, metric, n_rows, n_values) of all groups and of the whole table, from one scan."""
    source = _known(df, day, metric, segments).withColumn(WHOLE, F.lit("all"))
    return group_daily(source, day, metric, func, [*segments, WHOLE]).withColumnRenamed(day, "day")


def base_series(daily: DataFrame) -> DataFrame:
    """(day, metric, total_count, delta_all) over all rows: one row per calendar day."""
    whole = daily.where(F.col("segment") == WHOLE).select("day", "metric", F.col("n_rows").alias("total_count"))
    return with_delta(whole, "day", "metric", out="delta_all")


def score_series(
    daily: DataFrame,
    window_size: int = 7,
    ml_contamination: float = 0.05,
    min_group_size: int = 2,
    center: str = "metric",
    calendar: bool = False,
    method: str = "exact",
) -> DataFrame:
    """Change and both scores of each (segment, group, day) of the daily table; a series depends on its own rows only.

    Series, scores and group sizes share one exchange on (segment, group).
    """
    large = keep_large_groups(daily.where(F.col("segment") != WHOLE), min_group_size).drop("n_rows")
    moved = with_delta(large, "day", "metric", SERIES)
    rolled = with_rolling_score(moved, "day", "metric", "delta", SERIES, window_size, center=center, calendar=calendar)
    return isolation_score(rolled, "day", "delta", SERIES, ml_contamination, method)


def contributions(series: DataFrame, base: DataFrame, clipped: bool = True) -> DataFrame:
    """Scored series with the share of each group in the change of the day. The base series is one row a calendar day, so it is broadcast."""
    joined = series.join(F.broadcast(base.select("day", "total_count", "delta_all")), "day", "left")
    return with_contribution(joined, clipped=clipped).drop("total_count", "delta_all")


def score_groups(
    df: DataFrame,
    day: str,
    metric: str,
    func: str | Callable[[Column], Column] = "mean",
    segments: Sequence[str] | None = None,
    clip_contributions: bool = True,
    **options,
) -> DataFrame:
    """One row per (segment, group, day): metric, change, both scores and the contribution; `options` are those of `score_series`.

    Runs one job when called: the daily table is written, and everything else reads it.
    """
    segments = list(segments) if segments else segment_columns(df, day, metric)
    daily = settled(all_daily(df, day, metric, func, segments))
    return contributions(score_series(daily, **options), base_series(daily), clip_contributions)


def significant_table(
    base: DataFrame,
    scored: DataFrame,
    segments: Sequence[str],
    z_threshold: float = 3.0,
    winner: str = "contribution",
) -> DataFrame:
    """One row per (day, segment) with the day's change and the winners; segments without a scored group are absent.

    Days times segment names is bounded by the calendar and the schema, so the window per segment is small.
    """
    winners = significant_groups(scored, "day", z_threshold, winner).withColumn("_seen", F.lit(True))
    frame = base.withColumn("segment", F.explode(F.array(*[F.lit(s) for s in segments])))
    whole = Window.partitionBy("segment")
    return (
        frame.join(winners, ["day", "segment"], "left")
        .withColumn("_any", F.max("_seen").over(whole))
        .where(F.col("_any"))
        .select("day", "metric", "total_count", "delta_all", "segment", "ml_group", "z_group", "group")
    )


def segment_anomalies(
    df: DataFrame,
    day: str = "snap_date_day",
    metric: str = "nps",
    func: str | Callable[[Column], Column] = "mean",
    segments: Sequence[str] | None = None,
    z_threshold: float = 3.0,
    winner: str = "contribution",
    **options,
) -> SegmentAnomalies:
    """Significant group per day and segment with the z-scores and contributions behind it.

    `options` are those of `score_series`, and `clip_contributions`. Runs one job when called: the daily table is written. Days without a flagged group have null groups; a segment whose
    groups are all too small is absent.
    """
    segments = list(segments) if segments else segment_columns(df, day, metric)
    daily = settled(all_daily(df, day, metric, func, segments))
    return anomalies_of(daily, segments, z_threshold, winner, **options)


def anomalies_of(
    daily: DataFrame, segments: Sequence[str], z_threshold: float, winner: str, clip_contributions: bool = True, **options
) -> SegmentAnomalies:
    """The result tables from a stored daily table."""
    base = base_series(daily)
    return result_tables(contributions(score_series(daily, **options), base, clip_contributions), base, segments, z_threshold, winner)


def result_tables(
    scored: DataFrame, base: DataFrame, segments: Sequence[str], z_threshold: float = 3.0, winner: str = "contribution"
) -> SegmentAnomalies:
    return SegmentAnomalies(
        significant_table(base, scored, segments, z_threshold, winner),
        scored.select("day", *SERIES, "z_score"),
        scored.select("day", *SERIES, "contribution"),
        scored,
        base,
    )


def detect_to_tables(
    df: DataFrame,
    path: str,
    day: str = "snap_date_day",
    metric: str = "nps",
    segments: Sequence[str] | None = None,
    z_threshold: float = 3.0,
    winner: str = "contribution",
    wide: bool = False,
    **options,
) -> None:
    """Run the detector and write its three tables.

    The source is read once, for the daily table; everything else reads the written copies.
    """
    segments = list(segments) if segments else segment_columns(df, day, metric)
    func, clipped = options.pop("func", "mean"), options.pop("clip_contributions", True)
    daily = write_table(all_daily(df, day, metric, func, segments), f"{path}/daily")
    base = write_table(base_series(daily), f"{path}/base")
    scored = write_table(contributions(score_series(daily, **options), base, clipped), f"{path}/scored")
    write_detector(significant_table(base, scored, segments, z_threshold, winner), scored, path, wide)
