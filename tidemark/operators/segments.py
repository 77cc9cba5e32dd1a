"""Segment groups in long form: one row per (segment, group, day) in place of one column per group."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import clip, infinite_to_zero, nan_to_null, zero_when_flat
from tidemark.operators.series import daily_metric

CONTRIBUTION_DIGITS = 9
WIDE_COLUMNS = 2000


def segment_columns(df: DataFrame, day: str, metric: str) -> list[str]:
    """All columns but the day and the metric, sorted by name."""
    return sorted(set(df.columns) - {day, metric})


def to_long(df: DataFrame, day: str, metric: str, segments: Sequence[str] | None = None) -> DataFrame:
    """(day, metric, segment, group) with null groups left out; one pass for all segments."""
    segments = list(segments) if segments else segment_columns(df, day, metric)
    typed = df.select(day, metric, *[F.col(s).cast("string").alias(s) for s in segments])
    return typed.unpivot([day, metric], segments, "segment", "group").where(F.col("group").isNotNull())


def group_daily(
    df: DataFrame,
    day: str,
    metric: str,
    func: str | Callable[[Column], Column] = "mean",
    segments: Sequence[str] | None = None,
) -> DataFrame:
    """(segment, group, day, metric, n_rows, n_values). The unpivoted rows are combined before the shuffle."""
    return daily_metric(to_long(df, day, metric, segments), day, metric, func, ["segment", "group"])


def group_sizes(df: DataFrame, day: str, metric: str, segments: Sequence[str] | None = None) -> DataFrame:
    """Rows per (segment, group)."""
    return to_long(df, day, metric, segments).groupBy("segment", "group").agg(F.count(F.lit(1)).alias("n_rows"))


def keep_large_groups(daily: DataFrame, min_group_size: int) -> DataFrame:
    """Drop groups with fewer rows over the whole period; shares the partitioning of the series windows."""
    whole = Window.partitionBy("segment", "group")
    return (
        daily.withColumn("_size", F.sum("n_rows").over(whole))
        .where(F.col("_size") >= min_group_size)
        .drop("_size")
    )


def with_contribution(
    df: DataFrame,
    delta: str = "delta",
    count: str = "n_values",
    delta_all: str = "delta_all",
    total: str = "total_count",
    clipped: bool = True,
    out: str = "contribution",
) -> DataFrame:
    """Share of a group in the change of the day: its change, weighted by its rows, over the total change."""
    weight = F.col(count) / F.col(total)
    share = infinite_to_zero(F.try_divide(F.col(delta) * weight, F.col(delta_all)))
    if clipped:
        share = clip(share, -1.0, 1.0)
    return df.withColumn(out, zero_when_flat(F.col(delta_all), share))


def rolling_anomaly(z: str | Column, threshold: float) -> Column:
    """A null or NaN score is no anomaly."""
    column = F.col(z) if isinstance(z, str) else z
    return F.coalesce(nan_to_null(F.abs(column)) > threshold, F.lit(False))


def _strength(contribution: Column) -> Column:
    return -F.round(F.abs(contribution), CONTRIBUTION_DIGITS)


def winner(flag: Column, group: str, contribution: str, order: Column | None = None) -> Column:
    """Aggregate: flagged group with the largest absolute contribution, ties to the smallest name.

    With `order` the flagged group that comes first in that order wins instead.
    """
    key = _strength(F.col(contribution)) if order is None else order
    usable = flag & F.col(contribution).isNotNull()
    return F.min(F.when(usable, F.struct(key.alias("k"), F.col(group).alias("g"))))["g"]


def significant_groups(
    scored: DataFrame, day: str = "day", z_threshold: float = 3.0, by: str = "contribution"
) -> DataFrame:
    """(day, segment, ml_group, z_group, group): winners of both rules, `group` where they agree.

    by='first' takes the flagged group that appeared first in the data.
    """
    order = None
    if by == "first":
        whole = Window.partitionBy("segment", "group")
        scored = scored.withColumn("_first_day", F.min(day).over(whole))
        order = F.col("_first_day")
    return (
        scored.groupBy(day, "segment")
        .agg(
            winner(F.col("ml_anomaly"), "group", "contribution", order).alias("ml_group"),
            winner(rolling_anomaly("z_score", z_threshold), "group", "contribution", order).alias("z_group"),
        )
        .withColumn("group", F.when(F.col("ml_group") == F.col("z_group"), F.col("ml_group")))
    )


def wide_names(df: DataFrame, measure: str, columns: int = WIDE_COLUMNS) -> Iterator[tuple[str, list[str]]]:
    """(segment, sorted column names of the wide form), at most `columns` names at a time; all groups come in some block."""
    rows = df.select("segment", F.concat_ws("_", F.lit(measure), "segment", "group").alias("_name")).distinct()
    block: list[str] = []
    segment = None
    for row in rows.orderBy("segment", "_name").toLocalIterator():
        if block and (row["segment"] != segment or len(block) == columns):
            yield segment, block
            block = []
        segment = row["segment"]
        block.append(row["_name"])
    if block:
        yield segment, block


def to_wide(df: DataFrame, day: str, measure: str, names: Sequence[str]) -> DataFrame:
    """One row per day, one column per name `measure_segment_group`."""
    label = F.concat_ws("_", F.lit(measure), "segment", "group")
    return df.withColumn("_name", label).groupBy(day).pivot("_name", list(names)).agg(F.first(measure))


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def suffix_columns(df: DataFrame, suffix: str, keep: Sequence[str]) -> DataFrame:
    """Rename all columns outside `keep` to `name_suffix`."""
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in df.columns if c not in keep})
