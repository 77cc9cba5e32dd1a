"""Writers: processed tables, period reloads and detector outputs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.calendar import within_period
from tidemark.operators.segments import to_wide, wide_names
from tidemark.schemas import PARTITION_DAY
from tidemark.session import settled


def by_day(df: DataFrame, day: str) -> DataFrame:
    """Rows of a day together; adaptive execution splits a large day and joins small ones by size."""
    return df.hint("rebalance", F.col(day))


@contextmanager
def _dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrite only the partitions that get rows; the setting of the session comes back afterwards."""
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def reload_period(existing: DataFrame, fresh: DataFrame, start: date, end: date, day: str = PARTITION_DAY) -> DataFrame:
    """The table after a reload: old rows outside the period and the fresh rows.

    Days of the period without a fresh row end up empty. Old rows without a day are kept.
    """
    outside = F.coalesce(~within_period(day, start, end), F.lit(True))
    return existing.where(outside).unionByName(fresh)


def create_table(spark: SparkSession, name: str, schema: StructType, day: str = PARTITION_DAY, path: str | None = None) -> None:
    """Empty parquet table partitioned by day, if it does not exist."""
    if spark.catalog.tableExists(name):
        return
    empty = spark.createDataFrame([], schema)
    writer = empty.write.format("parquet").partitionBy(day)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def reload_table(
    spark: SparkSession, name: str, fresh: DataFrame, start: date, end: date, day: str = PARTITION_DAY
) -> None:
    """Reload a period of a day-partitioned table in place.

    Days with fresh rows are overwritten as partitions and the other days of the period dropped, so days
    outside it are neither read nor written. Repeating the call gives the same table, also after a failed
    one. Fresh rows are computed once, and a row outside the period is an error. Only the list of days, at
    most the length of the period, reaches the driver.
    """
    columns = spark.table(name).columns
    inside = F.coalesce(within_period(day, start, end), F.lit(False))
    stray = F.raise_error(F.concat(F.lit(f"outside [{start}, {end}): "), F.coalesce(F.col(day).cast("string"), F.lit("null"))))
    fresh = settled(fresh.select(*columns).withColumn(day, F.when(inside, F.col(day)).otherwise(stray)))
    with _dynamic_overwrite(spark):
        by_day(fresh, day).write.mode("overwrite").insertInto(name)
    filled = {r[day] for r in fresh.select(day).distinct().collect()}
    partitions = [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    for text in partitions:
        if text.startswith("__"):
            continue
        d = date.fromisoformat(text)
        if start <= d < end and d not in filled:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({day} = DATE '{d.isoformat()}')")


def write_processed(df: DataFrame, path: str, day: str = "snap_date_day") -> None:
    """One parquet table per dataset, partitioned by day."""
    by_day(df, day).write.mode("overwrite").partitionBy(day).parquet(path)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write a parquet table and return a DataFrame that reads it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def write_detector(significant: DataFrame, stored: DataFrame, path: str, wide: bool = False, day: str = "day") -> None:
    """Significant groups, z-scores and contributions as three tables, from scored series already stored.

    With `wide` CSV exports are added: the significant groups with one column per segment, and the measures with one column per
    group, per segment in blocks of columns, so any number of groups can be exported and the driver holds the names of one
    block. Blocks are numbered folders; `*_wide_blocks` has the segment of each number.
    """
    significant.write.mode("overwrite").parquet(f"{path}/significant")
    for measure, folder in (("z_score", "z_scores"), ("contribution", "contributions")):
        long = stored.select(day, "segment", "group", measure)
        long.write.mode("overwrite").parquet(f"{path}/{folder}")
        if wide:
            stored_long, blocks = long.sparkSession.read.parquet(f"{path}/{folder}"), []
            for number, (segment, names) in enumerate(wide_names(stored_long, measure)):
                part = stored_long.where(F.col("segment") == segment)
                table = to_wide(part, day, measure, names).orderBy(day)
                table.write.mode("overwrite").option("header", True).csv(f"{path}/{folder}_wide/{number:05d}")
                blocks.append((number, segment))
            # One row a block.
            long.sparkSession.createDataFrame(blocks, "block int, segment string").write.mode("overwrite").parquet(f"{path}/{folder}_wide_blocks")
    if wide:
        rows = long.sparkSession.read.parquet(f"{path}/significant")
        by_segment = significant_wide(rows, day).orderBy(day)
        by_segment.write.mode("overwrite").option("header", True).csv(f"{path}/significant_wide")


def significant_wide(significant: DataFrame, day: str = "day") -> DataFrame:
    """One row per day: metric, total_count, delta_all, and a column per segment with its significant group."""
    segments = [r["segment"] for r in significant.select("segment").distinct().orderBy("segment").collect()]
    return significant.groupBy(day, "metric", "total_count", "delta_all").pivot("segment", segments).agg(F.first("group"))
