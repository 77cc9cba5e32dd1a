"""Exact quantiles of groups of any size.

`percentile` keeps every distinct value of a group in one task. Here a group is narrowed instead: values
are counted, counts are binned, the bin that holds the wanted rank is kept, and the next round bins only
that range, until no range holds more than `limit` distinct values. Ranges end at values that occur, so each
round leaves out at least the values at one end, and a long tail costs rounds, not one large task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.salting import salted_join
from tidemark.session import settled

LIMIT = 20_000


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows per (keys, value), null keys and values left out."""
    present = F.col(value).isNotNull()
    for k in keys:
        present = present & F.col(k).isNotNull()
    return (
        df.where(present)
        .groupBy(*keys, F.col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )


def _ranks(sizes: DataFrame, keys: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """One row per (keys, wanted 0-based rank) with the starting range."""
    wanted = []
    for p in probs:
        position = (F.col("_size") - 1) * F.lit(float(p))
        wanted += [F.floor(position), F.ceil(position)]
    return sizes.select(
        *keys,
        F.explode(F.array_distinct(F.array(*wanted))).alias("_rank"),
        "_lo",
        "_hi",
        F.lit(0).cast("long").alias("_below"),
        F.col("_values").alias("_inside"),
    )


def _narrow(counts: DataFrame, state: DataFrame, keys: Sequence[str], bins: int) -> DataFrame:
    """Keep, per wanted rank, the bin of the current range that holds it."""
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    place = F.coalesce(F.try_divide(F.col("_v") - F.col("_lo"), width), F.lit(0.0))
    binned = (
        salted_join(counts, state, keys, ["_v"])
        .where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        .withColumn("_bin", F.least(F.floor(place), F.lit(bins - 1)))
        .groupBy(*keys, "_rank", "_bin")
        .agg(
            F.sum("_n").alias("_n"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
            F.count(F.lit(1)).alias("_inside"),
            F.first("_below").alias("_below"),
        )
    )
    return _holding(binned, keys, "_bin").select(*keys, "_rank", "_lo", "_hi", "_below", "_inside")


def _holding(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row whose running count covers the wanted rank; `_below` becomes the count before it."""
    w = Window.partitionBy(*keys, "_rank").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("_upto", F.col("_below") + F.sum("_n").over(w))
        .withColumn("_below", F.col("_upto") - F.col("_n"))
        .where((F.col("_below") <= F.col("_rank")) & (F.col("_rank") < F.col("_upto")))
    )


def _largest(state: DataFrame) -> int:
    return state.agg(F.max("_inside").alias("n")).first()["n"] or 0


def quantiles_of_counts(
    counts: DataFrame,
    keys: Sequence[str],
    probs: Sequence[float],
    names: Sequence[str],
    bins: int = 1024,
    limit: int = LIMIT,
) -> DataFrame:
    """(keys, n, one column per probability) from `value_counts`, linear between neighbours.

    Ranges above `limit` distinct values are narrowed round by round; the ranges of a round are one row for each
    (keys, wanted rank), and only the size of the largest reaches the driver. Counts are written once where a
    round is needed.
    """
    keys = list(keys)
    sizes = settled(counts.groupBy(*keys).agg(
        F.sum("_n").alias("_size"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count(F.lit(1)).alias("_values")
    ))
    state = _ranks(sizes, keys, probs)
    if _largest(state) > limit:
        counts = settled(counts)
    while _largest(state) > limit:
        state = settled(_narrow(counts, state, keys, bins))
    last = salted_join(counts, state, keys, ["_v"]).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    picked = _holding(last, keys, "_v").select(*keys, "_rank", "_v")
    by_rank = picked.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at")
    )
    joined = by_rank.join(sizes.select(*keys, "_size"), keys)
    columns = []
    for p, name in zip(probs, names):
        position = (F.col("_size") - 1) * F.lit(float(p))
        low = F.element_at("_at", F.floor(position))
        high = F.element_at("_at", F.ceil(position))
        columns.append((low + (high - low) * (position - F.floor(position))).alias(name))
    return joined.select(*keys, F.col("_size").alias("n"), *columns)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    bins: int = 1024,
    limit: int = LIMIT,
) -> DataFrame:
    """Exact interpolated quantiles of `value` per group; no task sees more than `limit` distinct values of one."""
    return quantiles_of_counts(value_counts(df, keys, value), keys, probs, names, bins, limit)
