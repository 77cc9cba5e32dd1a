"""Correlation of two daily series with two-sided p-values."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.operators.ranking import average_rank, average_ranks
from tidemark.operators.series import daily_metric

# The functions travel with the query, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def guarded_corr(x: str, y: str) -> Column:
    """Pearson correlation; null when either series is constant."""
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))


def t_statistic(r: Column, n: Column) -> Column:
    """t with n-2 degrees of freedom; null for a perfect correlation or fewer than three points."""
    rest = F.lit(1.0) - r * r
    return F.when((n > 2) & (rest > 0), r * F.sqrt((n - 2) / F.when(rest > 0, rest)))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz steps)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = d
    for m in range(1, 1000):
        for top in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + top * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + top / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def two_sided_p(t: float, dof: float) -> float:
    """P(|T| >= |t|) for Student's t."""
    x = dof / (dof + t * t)
    a, b = dof / 2.0, 0.5
    if x >= 1.0:
        return 1.0
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


@F.pandas_udf(DoubleType())
def p_value(t: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of correlation t statistics; runs on result rows only."""
    return pd.Series(
        [None if pd.isna(a) or k <= 2 else two_sided_p(float(a), float(k) - 2.0) for a, k in zip(t, n)],
        dtype="float64",
    )


def correlations(pairs: DataFrame, x: str, y: str) -> DataFrame:
    """One row: n, pearson, spearman and their t statistics, for pairs with both values present.

    Ranks sort all pairs together, which fits daily series: one row per calendar day.
    """
    present = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    ranked = average_rank(average_rank(present, x, "_rx"), y, "_ry")
    n = F.col("n")
    return ranked.agg(
        F.count(F.lit(1)).alias("n"),
        guarded_corr(x, y).alias("pearson"),
        guarded_corr("_rx", "_ry").alias("spearman"),
    ).withColumns({f"{k}_t": t_statistic(F.col(k), n) for k in ("pearson", "spearman")})


def column_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """`correlations` of two columns of a table of any length, with p-values; ranks are taken range by range."""
    pairs = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    ranked = average_ranks(pairs.where(~F.isnan("_x") & ~F.isnan("_y")), ["_x", "_y"])
    found = ranked.agg(
        F.count(F.lit(1)).alias("n"), guarded_corr("_x", "_y").alias("pearson"), guarded_corr("_x_rank", "_y_rank").alias("spearman")
    )
    return with_p_values(found.withColumns({f"{k}_t": t_statistic(F.col(k), F.col("n")) for k in ("pearson", "spearman")}))


def with_p_values(result: DataFrame) -> DataFrame:
    """Add pearson_p and spearman_p; a perfect correlation has p = 0."""
    columns = {}
    for k in ("pearson", "spearman"):
        perfect = (F.abs(F.col(k)) >= 1.0) & (F.col("n") > 2)
        columns[f"{k}_p"] = F.when(perfect, F.lit(0.0)).otherwise(p_value(F.col(f"{k}_t"), F.col("n")))
    return result.withColumns(columns)


def daily_pairs(
    a: DataFrame, b: DataFrame, day: str, metric_a: str, metric_b: str, func_a: str, func_b: str
) -> DataFrame:
    """(day, metric_1, metric_2) for days present in both tables. Both sides are aggregated before the join."""
    left = daily_metric(a, day, metric_a, func_a, out="metric_1").select(day, "metric_1")
    right = daily_metric(b, day, metric_b, func_b, out="metric_2").select(day, "metric_2")
    return left.join(right, day)


def series_correlation(
    a: DataFrame, b: DataFrame, day: str, metric_a: str, metric_b: str, func_a: str = "mean", func_b: str = "size"
) -> DataFrame:
    """Pearson and Spearman correlation of two daily series with t statistics and p-values."""
    pairs = daily_pairs(a, b, day, metric_a, metric_b, func_a, func_b)
    return with_p_values(correlations(pairs, "metric_1", "metric_2"))
