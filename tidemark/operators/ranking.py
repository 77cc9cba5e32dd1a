"""Ranks and integer codes over whole columns without sorting them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.salting import hot_join
from tidemark.session import settled

SPLITTERS = 255


def category_codes(df: DataFrame, c: str, code: str = "code") -> DataFrame:
    """(value, code): codes 0, 1, 2 ... in sorted order of the distinct non-null values.

    A fixed number of splitters, the distinct values with the smallest hashes, cuts the values into
    ordered buckets of similar size. Values are numbered inside their bucket and shifted by the number
    of values in earlier buckets. Only the splitters and the bucket sizes are small tables.
    """
    distinct = df.where(F.col(c).isNotNull()).select(F.col(c).alias("value")).distinct()
    sample = distinct.orderBy(F.xxhash64("value"), "value").limit(SPLITTERS)
    splitters = sorted(r["value"] for r in sample.collect())
    if not splitters:
        return distinct.withColumn(code, F.lit(None).cast("long"))
    bounds = F.array(*[F.lit(s) for s in splitters])
    bucketed = distinct.withColumn(
        "_bucket", F.aggregate(bounds, F.lit(0), lambda n, s: n + F.when(s <= F.col("value"), 1).otherwise(0))
    )
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_bucket").orderBy("value")
    return (
        bucketed.withColumn("_row", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .select("value", (F.col("_row") - 1 + F.col("_offset")).alias(code))
    )


def _looked_up(df: DataFrame, c: str, dim: DataFrame, out: str) -> DataFrame:
    """Left lookup of a column; rows of a hot value are joined in place, null values without a join."""
    known = df.where(F.col(c).isNotNull())
    sizes = settled(known.groupBy(c).agg(F.count(F.lit(1)).alias("_rows")))
    total = sizes.agg(F.sum("_rows")).first()[0] or 0
    found = hot_join(known, sizes.join(dim, c, "left"), [c], "_rows", total)
    return found.unionByName(df.where(F.col(c).isNull()).withColumn(out, F.lit(None).cast(dim.schema[out].dataType))).select(c, *[x for x in df.columns if x != c], out)


def encode(df: DataFrame, c: str, codes: DataFrame, out: str, code: str = "code") -> DataFrame:
    """Add the integer code of a category; null stays null. Counts the categories when called."""
    return _looked_up(df, c, codes.select(F.col("value").alias(c), F.col(code).alias(out)), out)


def decode(df: DataFrame, c: str, codes: DataFrame, out: str, code: str = "code") -> DataFrame:
    """Add the category of an integer code. Counts the codes when called."""
    return _looked_up(df, c, codes.select(F.col(code).alias(c), F.col("value").alias(out)), out)


def value_ranks(df: DataFrame, c: str, out: str) -> DataFrame:
    """(value, out, n): mean rank and number of the rows of each distinct value, for columns of any length.

    Values are counted first, so ties are one row. Ranges of the distinct values add up their counts by themselves; a table of one row a
    range has the rows before each.
    """
    counts = settled(df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n")))
    ranged = settled(counts.repartitionByRange("value").withColumn("_range", F.spark_partition_id()))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.sum("n").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("_before", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(F.broadcast(starts), "_range")
    return placed.select("value", (F.col("_start") + F.col("_before") + (F.col("n") + 1) / F.lit(2.0)).alias(out), "n")


def average_ranks(df: DataFrame, columns: Sequence[str], suffix: str = "_rank") -> DataFrame:
    """The rows in which all of the columns are known, with their mean ranks; no task sorts a whole column. Runs jobs when called."""
    known = df
    for c in columns:
        known = known.where(F.col(c).isNotNull())
    known = settled(known)
    total, ranked = known.count(), known
    for c in columns:
        ranks = settled(value_ranks(known, c, f"{c}{suffix}").withColumnRenamed("value", c))
        ranked = hot_join(ranked, ranks, [c], "n", total)
    return ranked


def average_rank(df: DataFrame, c: str, out: str) -> DataFrame:
    """Rank with ties sharing their mean rank. For daily series: one row per day, so one task holds it."""
    order = Window.orderBy(c)
    ties = order.rangeBetween(Window.currentRow, Window.currentRow)
    return df.withColumn(out, F.rank().over(order) + (F.count(F.lit(1)).over(ties) - 1) / F.lit(2.0))
