"""Table profile: missing shares, frequencies, histograms, densities and box statistics as result tables.

Every operator works on the long form (column, value), so one pass covers all columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from tidemark.operators.quantiles import LIMIT, quantiles_of_counts, value_counts
from tidemark.operators.salting import salted_join

BINS = 30
MAX_CATEGORIES = 15
GRID = 200
#: Cells of the dense grid between two points of a curve.
FINE = 8
WHISKER = 1.5


def columns_of_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the numeric or text columns."""
    wanted = {"numeric": NumericType, "text": StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_rows, n_null) from one aggregate over the table."""
    columns = list(columns or df.columns)
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    )
    return counted.unpivot(["n_rows"], columns, "column", "n_null").select("column", "n_rows", "n_null")


def table_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def missing_share(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing_percent) for columns with missing values, highest first."""
    share = F.lit(100.0) * F.try_divide(F.col("n_null"), F.col("n_rows"))
    return (
        null_counts(df, columns)
        .where(F.col("n_null") > 0)
        .select("column", share.alias("missing_percent"))
        .orderBy(F.desc("missing_percent"), "column")
    )


def long_values(df: DataFrame, columns: Sequence[str], dtype: str) -> DataFrame:
    """(column, value) with nulls left out."""
    typed = df.select(*[F.col(c).cast(dtype).alias(c) for c in columns])
    return typed.unpivot([], list(columns), "column", "value").where(F.col("value").isNotNull())


def frequencies(df: DataFrame, c: str) -> DataFrame:
    """(value, n), most frequent first, ties by value."""
    return (
        df.where(F.col(c).isNotNull())
        .groupBy(F.col(c).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
    )


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """(column, n_distinct) without nulls."""
    count = F.approx_count_distinct("value") if approximate else F.count_distinct("value")
    return long_values(df, columns, "string").groupBy("column").agg(count.alias("n_distinct"))


def top_categories(df: DataFrame, columns: Sequence[str], k: int = MAX_CATEGORIES) -> DataFrame:
    """(column, value, n, place): the k most frequent values of each column.

    The rank filter is applied before the exchange too, so a column with many values sends k per task.
    """
    order = Window.partitionBy("column").orderBy(F.desc("n"), "value")
    return (
        long_values(df, columns, "string")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= k)
    )


def group_means(df: DataFrame, group: str, metric: str) -> DataFrame:
    """(group, mean), highest first."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.avg(metric).alias("mean"))
        .orderBy(F.desc("mean"), group)
    )


def top_groups(df: DataFrame, group: str, metric: str, k: int = 10) -> DataFrame:
    return group_means(df, group, metric).limit(k)


def rows_of_top_groups(df: DataFrame, group: str, metric: str, k: int = 10) -> DataFrame:
    """All rows whose group is among the k best by mean."""
    return df.join(F.broadcast(top_groups(df, group, metric, k).select(group)), group, "left_semi")


def box_statistics(df: DataFrame, group: str, metric: str, bins: int = 1024, limit: int = LIMIT) -> DataFrame:
    """(group, n, q1, median, q3, whisker_low, whisker_high); whiskers end at data inside 1.5 IQR."""
    counts = value_counts(df, [group], metric)
    quartiles = quantiles_of_counts(counts, [group], [0.25, 0.5, 0.75], ["q1", "median", "q3"], bins, limit)
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        salted_join(counts, quartiles, [group], ["_v"])
        .groupBy(group)
        .agg(
            F.sum("_n").alias("n"),
            *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        )
    )


def _with_bin(values: DataFrame, bins: int) -> DataFrame:
    """Equal-width bin of `value` in [lo, hi]; the last bin is closed. A single value fills the middle of a unit range."""
    flat = F.col("lo") == F.col("hi")
    ranged = values.withColumns(
        {
            "lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
            "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")),
        }
    ).withColumn("width", (F.col("hi") - F.col("lo")) / F.lit(bins))
    place = F.floor((F.col("value") - F.col("lo")) / F.col("width"))
    return ranged.withColumn("bin", F.least(place, F.lit(bins - 1)).cast("int"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS, min_distinct: int = MAX_CATEGORIES) -> DataFrame:
    """(column, bin, bin_start, bin_end, n) for numeric columns with more than `min_distinct` values."""
    values = long_values(df, columns, "double")
    spread = values.groupBy("column").agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.approx_count_distinct("value").alias("_guess")
    )
    # A sketch of few values never counts more than there are, so a high estimate is proof. The others are
    # counted exactly: they have few values, which combine on the map side.
    sure = F.col("_guess") > 2 * min_distinct + 2
    unsure = values.join(F.broadcast(spread.where(~sure).select("column")), "column", "left_semi")
    exact = unsure.groupBy("column").agg(F.count_distinct("value").alias("_d"))
    ranges = (
        spread.join(F.broadcast(exact), "column", "left")
        .where(sure | (F.col("_d") > min_distinct))
        .select("column", "lo", "hi")
    )
    # One row per column of the table: bounded by the schema.
    binned = _with_bin(values.join(F.broadcast(ranges), "column"), bins)
    return (
        binned.groupBy("column", "lo", "width", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "column",
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
            (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("bin_end"),
            "n",
        )
    )


def density_histogram(df: DataFrame, group: str, metric: str, bins: int = BINS) -> DataFrame:
    """(group, bin, bin_start, n, density): bins over each group's own range, total area 1."""
    values = value_counts(df, [group], metric).withColumnRenamed("_v", "value")
    ranges = values.groupBy(group).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("_n").alias("total")
    )
    return (
        _with_bin(salted_join(values, ranges, [group], ["value"]), bins)
        .groupBy(group, "lo", "width", "total", "bin")
        .agg(F.sum("_n").alias("n"))
        .select(
            group,
            "bin",
            (F.col("lo") + F.col("bin") * F.col("width")).alias("bin_start"),
            "n",
            (F.col("n") / (F.col("total") * F.col("width"))).alias("density"),
        )
    )


def _curve_ranges(values: DataFrame) -> DataFrame:
    """(column, n, lo, hi, h): one row per column; h is the bandwidth, deviation * n^(-1/5)."""
    spread = values.groupBy("column").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.stddev_samp("value").alias("sd")
    )
    return spread.where(F.col("sd") > 0).select("column", "n", "lo", "hi", (F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("h"))


def density_curve(df: DataFrame, columns: Sequence[str], grid: int = GRID, fine: int = FINE, exact: bool = False) -> DataFrame:
    """(column, step, x, density): Gaussian kernel density on an even grid from minimum to maximum.

    Each value is shared out between the two neighbours of a grid `fine` times as dense, so a task hands on at most
    (grid - 1) * fine + 1 weights a column; the curve is the convolution of these with the kernel. With d the
    width of the dense grid the error is at most 0.05 * (d / h)^2 / h. `exact` adds up the kernel of every distinct value instead.
    """
    values = long_values(df, columns, "double")
    ranges = _curve_ranges(values)
    steps = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("step")
    x = F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("step") / F.lit(grid - 1)
    if exact:
        weights = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("w")).join(F.broadcast(ranges), "column")
        u = (x - F.col("value")) / F.col("h")
    else:
        cells = (grid - 1) * fine
        width = (F.col("hi") - F.col("lo")) / F.lit(cells)
        place = (F.col("value") - F.col("lo")) / width
        placed = values.join(F.broadcast(ranges), "column").withColumn("_at", F.least(F.floor(place), F.lit(cells - 1)))
        placed = placed.withColumn("_share", place - F.col("_at"))
        halves = F.inline(F.array(F.struct(F.col("_at").alias("at"), (1 - F.col("_share")).alias("w")), F.struct((F.col("_at") + 1).alias("at"), F.col("_share").alias("w"))))
        weights = placed.select("column", halves).groupBy("column", "at").agg(F.sum("w").alias("w")).join(F.broadcast(ranges), "column")
        u = (F.col("step") * fine - F.col("at")) * width / F.col("h")
    summed = weights.select("*", steps).groupBy("column", "step", x.alias("x"), "n", "h").agg(F.sum(F.col("w") * F.exp(F.lit(-0.5) * u * u)).alias("s"))
    return summed.select("column", "step", "x", (F.col("s") / (F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))).alias("density"))


def sorted_groups(df: DataFrame, c: str) -> DataFrame:
    """Distinct non-null values in order."""
    return df.where(F.col(c).isNotNull()).select(c).distinct().orderBy(c)
