"""Isolation score of a one-dimensional series: how few random cuts separate a day from the others.

Main form: the expected depth in closed form. A gap between neighbouring distinct values lies on the
path of x with probability gap / (distance from x to the far edge of the gap), so the expected depth is
the sum of these over all gaps. It has no tree noise. Second form: a seeded forest (Liu, Ting, Zhou,
"Isolation Forest", 2008). Both work on daily series, one value per calendar day, so a series is a few
thousand numbers at any data size.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

# The functions travel with the query, so workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGITS = 9
BLOCK = 256


def expected_depth(values: np.ndarray) -> np.ndarray:
    """Expected depth of each value; NaN stays NaN. Blocks of rows keep the memory linear."""
    out = np.full(len(values), np.nan)
    known = ~np.isnan(values)
    points, place = np.unique(values[known], return_inverse=True)
    if len(points) < 2:
        out[known] = 0.0
        return out
    gaps, last = np.diff(points), len(points)
    k = np.arange(last - 1)
    depth = np.empty(last)
    for start in range(0, last, BLOCK):
        stop = min(start + BLOCK, last)
        i, x = np.arange(start, stop)[:, None], points[start:stop, None]
        # Distance to the far edge of each gap above and below the point; gaps on the other side drop out.
        above, below = points[start + 1 :] - x, x - points[: stop - 1]
        above[:, : stop - start][k[start:stop] < i] = np.inf
        below[:, start:][k[start : stop - 1] >= i] = np.inf
        np.divide(gaps[start:], above, out=above)
        np.divide(gaps[: stop - 1], below, out=below)
        depth[start:stop] = above.sum(axis=1) + below.sum(axis=1)
    out[known] = depth[place]
    return out


def _mean_path(n: float) -> float:
    """Mean depth of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649015329) - 2.0 * (n - 1) / n if n > 2 else 1.0


def forest_depth(values: np.ndarray, trees: int = 100, sample: int = 256, seed: int = 42) -> np.ndarray:
    """Mean depth over a seeded forest of random cuts on subsamples; NaN stays NaN."""
    out = np.full(len(values), np.nan)
    known = ~np.isnan(values)
    x = values[known]
    if len(x) == 0:
        return out
    rng = np.random.default_rng(seed)
    size = min(sample, len(x))
    limit = max(1, math.ceil(math.log2(max(size, 2))))
    total = np.zeros(len(x))
    for _ in range(trees):
        pending = [(rng.choice(x, size, replace=False), np.arange(len(x)), 0)]
        while pending:
            part, rows, depth = pending.pop()
            if len(rows) == 0:
                continue
            low, high = (part.min(), part.max()) if len(part) else (0.0, 0.0)
            if depth == limit or len(part) <= 1 or low == high:
                total[rows] += depth + _mean_path(len(part))
                continue
            cut = rng.uniform(low, high)
            left = x[rows] < cut
            pending.append((part[part < cut], rows[left], depth + 1))
            pending.append((part[part >= cut], rows[~left], depth + 1))
    out[known] = total / trees
    return out


@F.pandas_udf(ArrayType(DoubleType()))
def _expected_depths(series: pd.Series) -> pd.Series:
    return series.map(lambda a: expected_depth(np.asarray(a, dtype="float64")))


@F.pandas_udf(ArrayType(DoubleType()))
def _forest_depths(series: pd.Series) -> pd.Series:
    return series.map(lambda a: forest_depth(np.asarray(a, dtype="float64")))


def depths_of_array(values: str | Column, method: str = "exact") -> Column:
    """Depth per element of an array of doubles."""
    return {"exact": _expected_depths, "forest": _forest_depths}[method](values)


def isolation_score(
    df: DataFrame,
    day: str,
    value: str = "delta",
    keys: Sequence[str] = (),
    contamination: float = 0.05,
    method: str = "exact",
) -> DataFrame:
    """Add `depth` and `ml_anomaly` to daily series keyed by (keys, day).

    A day is flagged when its depth lies below the `contamination` quantile of its series. All columns of
    a series travel as one array row, so one exchange on the keys serves scoring and threshold.
    """
    others = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(day, *[c for c in others if c != day]))).alias("_s"))
    points = F.transform("_s", lambda s: F.round(s[value], DIGITS))
    depths = F.transform(depths_of_array(points, method), lambda d: F.round(d, DIGITS))
    scored = packed.withColumn("_d", depths)
    known = F.filter("_d", lambda d: d.isNotNull() & ~F.isnan(d))
    flat = (
        scored.withColumn("_limit", array_quantile(known, contamination))
        .select(*keys, "_limit", F.inline(F.arrays_zip("_s", "_d")))
        .select(*keys, *[F.col("_s")[c].alias(c) for c in others], F.nanvl("_d", F.lit(None).cast("double")).alias("depth"), "_limit")
    )
    flagged = F.coalesce(F.col("depth") < F.col("_limit"), F.lit(False))
    return flat.withColumn("ml_anomaly", flagged).drop("_limit")


def array_quantile(values: Column, p: float) -> Column:
    """Linear quantile of an array of numbers; null for an empty one."""
    ordered = F.array_sort(values)
    position = (F.size(values) - 1) * F.lit(float(p))
    low = F.try_element_at(ordered, (F.floor(position) + 1).cast("int"))
    high = F.try_element_at(ordered, (F.ceil(position) + 1).cast("int"))
    return F.when(F.size(values) > 0, low + (high - low) * (position - F.floor(position)))
