"""Site and cell anomaly flags: daily inquiry counts against the other days of the same week of the month.

A window partition is one cell in one week, so it never holds more than seven days whatever the data size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the rule.
Z_SCALE = 0.6745
Z_LIMIT = 3
MIN_RANGE = 3
LARGE_EXCESS = 10

PERIOD_KEYS = ["year", "month", "week", "day"]
CELL_KEYS = ["os_os_id", "sk_bmt_id"]


def date_parts(ts: str | Column) -> dict[str, Column]:
    """Year, month, week of the month and day of the month."""
    column = F.col(ts) if isinstance(ts, str) else ts
    day = F.dayofmonth(column)
    return {
        "year": F.year(column),
        "month": F.month(column),
        "week": F.ceil(day / F.lit(7)).cast("int"),
        "day": day,
    }


def cell_counts(
    facts: DataFrame, cells: DataFrame, organisations: DataFrame, ts: str = "create_date", dedupe: bool = False
) -> DataFrame:
    """Inquiries per site, cell and day, with the fan-out of the dimensions kept.

    Inquiries are counted per cell and day before the dimensions come in, so only day totals are shuffled
    and joined. Several rows of a cell or several regions of an organisation multiply the count, as a row
    join would; `dedupe` counts each organisation once.
    """
    per_cell = facts.groupBy("sk_bmt_id", F.to_date(ts).alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    regions = organisations.select("os_os_id", "ro").distinct().groupBy("os_os_id").agg(
        F.lit(1).cast("long").alias("_fan") if dedupe else F.count(F.lit(1)).alias("_fan")
    )
    joined = (
        per_cell.join(cells.select("sk_bmt_id", "os_os_id"), "sk_bmt_id", "left")
        .join(regions, "os_os_id", "left")
        .withColumns(date_parts("_day"))
    )
    rows = F.col("_n") * F.coalesce("_fan", F.lit(1))
    return joined.groupBy(*CELL_KEYS, *PERIOD_KEYS).agg(F.sum(rows).alias("c"))


def week_window():
    return Window.partitionBy(*CELL_KEYS, "year", "month", "week")


def with_week_statistics(counts: DataFrame, center: str = "mean") -> DataFrame:
    """Median, mean, extremes and deviation median of the week. `mad` is around the mean by default."""
    w = week_window()
    first = counts.withColumns(
        {
            "m": F.median("c").over(w),
            "sr": F.avg("c").over(w),
            "c_maximum": F.max(F.abs("c")).over(w),
            "c_minimum": F.min(F.abs("c")).over(w),
        }
    )
    middle = F.col("sr") if center == "mean" else F.col("m")
    return first.withColumn("mad", F.median(F.abs(F.col("c") - middle)).over(w))


def with_flag(stats: DataFrame) -> DataFrame:
    """Modified z, range, flag and the excess over the minimum and the median of flagged days."""
    z = F.abs(F.try_divide(F.lit(Z_SCALE) * (F.col("c") - F.col("m")), F.nullif(F.col("mad"), F.lit(0.0))))
    flag = (
        F.when(F.col("maxmin") < MIN_RANGE, 0)
        .when(F.col("c") - F.col("c_minimum") >= LARGE_EXCESS, 1)
        .when(F.col("z_modif") > Z_LIMIT, 1)
        .otherwise(0)
    )
    flagged = F.col("flag_indicator") == 1
    return (
        stats.withColumns({"z_modif": z, "maxmin": F.col("c_maximum") - F.col("c_minimum")})
        .withColumn("flag_indicator", flag)
        .withColumns(
            {
                "excess_over_minimum": F.when(flagged, F.col("c") - F.col("c_minimum")).otherwise(0),
                "excess_over_median": F.when(flagged, F.col("c") - F.col("m")).otherwise(0.0),
            }
        )
    )


def flag_sums(flags: DataFrame) -> DataFrame:
    """Sum of flags per site, cell and day."""
    return flags.groupBy(*CELL_KEYS, *PERIOD_KEYS).agg(F.sum("flag_indicator").alias("flag_indicator"))
