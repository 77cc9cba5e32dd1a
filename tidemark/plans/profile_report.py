"""Profile of a survey or inquiry table: the data behind each chart, as one result table per topic."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import age_bin
from tidemark.operators.columns import select_available
from tidemark.operators.profile import (
    box_statistics,
    columns_of_type,
    density_curve,
    density_histogram,
    frequencies,
    histogram,
    missing_share,
    rows_of_top_groups,
    top_categories,
)
from tidemark.operators.segments import group_daily
from tidemark.operators.series import daily_metric
from tidemark.session import settled


@dataclass(frozen=True)
class ProfileColumns:
    """Names of the columns with a role in the report; topics of a role that is None are left out."""

    day: str = "snap_date_day"
    metric: str | None = "nps"
    region: str | None = "region_filial"
    age: str | None = "survey_age"
    revenue: str | None = "product_revenue_wo_iitc_vas_roam"


#: An inquiry table has no score: its daily series are numbers of rows.
INQUIRY_COLUMNS = ProfileColumns(metric=None, region="filial_id", age=None, revenue=None)


def profile(
    df: DataFrame, segments: Sequence[str], roles: ProfileColumns = ProfileColumns(), func: str | Callable[[Column], Column] | None = None
) -> dict[str, DataFrame]:
    """Missing shares, distributions, box statistics, densities and daily series by name.

    `func` aggregates the metric of a day, by default its mean, or the number of rows without a metric. Runs jobs when called.
    """
    func = func or ("mean" if roles.metric else "size")
    missing = missing_share(df)
    wanted = select_available(df, segments).columns
    roled = [c for c in (roles.day, roles.metric, roles.region, roles.age, roles.revenue) if c]
    # The source is read twice, for the gaps of all columns and for the columns in use; the topics share their written copy.
    df = settled(df.select(*dict.fromkeys([*wanted, *roled])))
    available = df.select(*wanted)
    numbers = columns_of_type(available, "numeric")
    report = {"missing": missing, "categories": top_categories(df, available.columns)}
    if numbers:
        # At most the bins of the schema's numbers: planned once, for the topic and for the categories beside it.
        report["histogram"] = settled(histogram(df, numbers))
        report["curve"] = density_curve(df, numbers)
        # Numbers with many values have a histogram in place of a frequency table.
        ranged = F.broadcast(report["histogram"].select("column").distinct())
        report["categories"] = report["categories"].join(ranged, "column", "left_anti")
    if roles.metric and roles.region:
        # Boxes are one row a group, written once however many of their numbers are asked for.
        report["region_box"] = settled(box_statistics(rows_of_top_groups(df, roles.region, roles.metric), roles.region, roles.metric))
    if roles.metric and roles.age:
        report["age_box"] = settled(box_statistics(df.withColumn("age_group", age_bin(roles.age)), "age_group", roles.metric))
    if roles.metric and roles.revenue:
        report["revenue_density"] = density_histogram(df, roles.revenue, roles.metric)
    if roles.region:
        report["regions"] = frequencies(df, roles.region)
    counted, metric = (df, roles.metric) if roles.metric else (df.withColumn("_row", F.lit(1)), "_row")
    report["daily"] = daily_metric(counted, roles.day, metric, func)
    report["daily_by_group"] = group_daily(counted, roles.day, metric, func, available.columns)
    return report


def report_rows(report: dict[str, DataFrame], keys: dict[str, tuple[str, str, str]]) -> DataFrame:
    """(topic, item, part, value): chosen columns of the tables in one long table. A topic may be told apart by a name behind `:`."""
    parts = [
        report[topic.split(":")[0]].select(
            F.lit(topic).alias("topic"),
            F.col(item).cast("string").alias("item"),
            F.col(part).cast("string").alias("part"),
            F.col(value).cast("double").alias("value"),
        )
        for topic, (item, part, value) in keys.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
