"""Daily series: aggregation by day, change to the previous present day, rolling scores."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.aggregates import aggregate
from tidemark.operators.quantiles import exact_quantiles

STD_FLOOR = 1e-6


def daily_metric(
    df: DataFrame,
    day: str,
    metric: str,
    func: str | Callable[[Column], Column] = "mean",
    keys: Sequence[str] = (),
    out: str = "metric",
) -> DataFrame:
    """(keys, day, metric, n_rows, n_values): one row per day that has rows.

    n_rows counts all rows, n_values those with a metric. For `median` an exact quantile join is used.
    """
    by = [*keys, day]
    counts = [F.count(F.lit(1)).alias("n_rows"), F.count(metric).alias("n_values")]
    if func != "median":
        return df.groupBy(*by).agg(aggregate(func, metric).alias(out), *counts)
    medians = exact_quantiles(df, by, metric, [0.5], [out]).drop("n")
    return df.groupBy(*by).agg(*counts).join(medians, by, "left").select(*by, out, "n_rows", "n_values")


def day_range(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.min(day).alias("min_day"), F.max(day).alias("max_day"))


def series_window(day: str, keys: Sequence[str] = ()):
    """Order of one series. Without keys it is meant for aggregated rows only: one row per calendar day."""
    return Window.partitionBy(*keys).orderBy(day) if keys else Window.orderBy(day)


def with_delta(df: DataFrame, day: str, metric: str, keys: Sequence[str] = (), out: str = "delta") -> DataFrame:
    """Change to the previous present day; a missing change takes the next known one.

    The next known change is the last one seen going back in time: a running frame over the reversed
    order is linear in the series, where a frame that reaches to its end is scanned anew for each row.
    """
    w = series_window(day, keys)
    backward = Window.partitionBy(*keys).orderBy(F.desc(day)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.col(metric) - F.lag(metric).over(w)).withColumn(
        out, F.last(out, ignorenulls=True).over(backward)
    )


def rolling_frame(day: str, keys: Sequence[str], window_size: int, calendar: bool = False):
    """The last `window_size` observed rows, or calendar days with `calendar`."""
    if not calendar:
        return series_window(day, keys).rowsBetween(-(window_size - 1), Window.currentRow)
    number = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    base = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return base.orderBy(number).rangeBetween(-(window_size - 1), Window.currentRow)


def with_rolling(
    df: DataFrame, day: str, metric: str, keys: Sequence[str] = (), window_size: int = 7, calendar: bool = False
) -> DataFrame:
    """Rolling mean and sample deviation; one row alone has no deviation."""
    w = rolling_frame(day, keys, window_size, calendar)
    return df.withColumns(
        {"rolling_mean": F.avg(metric).over(w), "rolling_std": F.stddev_samp(metric).over(w)}
    )


def with_rolling_score(
    df: DataFrame,
    day: str,
    metric: str,
    delta: str = "delta",
    keys: Sequence[str] = (),
    window_size: int = 7,
    center: str = "metric",
    calendar: bool = False,
    out: str = "z_score",
) -> DataFrame:
    """(delta - rolling mean) / (rolling deviation + 1e-6).

    The mean is that of the metric; with center='delta' that of the change itself.
    """
    w = rolling_frame(day, keys, window_size, calendar)
    middle = F.avg(metric if center == "metric" else delta).over(w)
    spread = F.stddev_samp(metric if center == "metric" else delta).over(w)
    return df.withColumn(out, (F.col(delta) - middle) / (spread + F.lit(STD_FLOOR)))
