"""Daily inquiry load: inquiries with topic, subscriber snapshot, category and site anomaly flag."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_key, month_start, quarter_start, week_start, within_period
from tidemark.operators.joins import join_history, join_lookup, join_snapshot, valid_as_of, spread_nulls
from tidemark.operators.site_flags import (
    PERIOD_KEYS,
    cell_counts,
    date_parts,
    flag_sums,
    with_flag,
    with_week_statistics,
)
from tidemark.schemas import INQUIRY_DAILY

# Fixed values of the load.
COUNTED_CATEGORIES = (1, 3, 4, 6, 7, 8, 9, 10)
COUNTED_COMPANY = 150

TOPIC_COLUMNS = ["code_level_1", "code_level_2", "code_level_3", "code_level_4", "full_name"]


@dataclass(frozen=True)
class InquiryDimensions:
    topics: DataFrame
    snapshot: DataFrame
    categories: DataFrame
    cells: DataFrame
    organisations: DataFrame


def counted_inquiries(
    facts: DataFrame,
    start: date,
    end: date,
    categories: tuple[int, ...] = COUNTED_CATEGORIES,
    company: int = COUNTED_COMPANY,
) -> DataFrame:
    """Inquiries that enter the site counts."""
    category = F.col("crcat_crcat_id")
    return facts.where(
        within_period("create_date", start, end)
        & category.isNotNull()
        & category.isin(*categories)
        & (F.col("comp_os_id") == company)
    )


def site_flags(
    facts: DataFrame,
    dims: InquiryDimensions,
    start: date,
    end: date,
    as_of: datetime | None = None,
    center: str = "mean",
    dedupe: bool = False,
) -> DataFrame:
    """(os_os_id, sk_bmt_id, year, month, week, day, flag_indicator)."""
    counts = cell_counts(
        counted_inquiries(facts, start, end),
        valid_as_of(dims.cells, as_of),
        valid_as_of(dims.organisations, as_of),
        dedupe=dedupe,
    )
    return flag_sums(with_flag(with_week_statistics(counts, center)))


def attach_flags(facts: DataFrame, flags: DataFrame) -> DataFrame:
    """Left join of the flag on site, cell and the date parts; inquiries without a counterpart get null."""
    side = flags.where(F.col("os_os_id").isNotNull()).select(
        F.col("os_os_id").alias("cr_os_os_id"), "sk_bmt_id", *PERIOD_KEYS, "flag_indicator"
    )
    parts = facts.withColumns(date_parts("create_date"))
    keys = ["cr_os_os_id", "sk_bmt_id", *PERIOD_KEYS]
    side = side.withColumnsRenamed({k: f"_side_{k}" for k in keys})
    on = spread_nulls(parts, side, [(parts[k], side[f"_side_{k}"]) for k in keys])
    return parts.join(side, on, "left").drop(*PERIOD_KEYS, *[f"_side_{k}" for k in keys])


def inquiry_daily(
    facts: DataFrame,
    dims: InquiryDimensions,
    start: date,
    end: date,
    as_of: datetime | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """The enriched inquiry fact of a half-open period; `options` go to `site_flags`."""
    period = facts.where(within_period("create_date", start, end))
    flags = site_flags(facts, dims, start, end, as_of, **(options or {}))
    with_topic = join_history(
        period,
        dims.topics,
        [("itpc_itpc_id", "itpc_id"), ("billing_filial_id", "billing_filial_id")],
        start,
        end,
        TOPIC_COLUMNS,
    )
    with_subscriber = join_snapshot(
        with_topic,
        dims.snapshot,
        "sk_subs_id",
        "create_date",
        start,
        end,
        ["filial_id", "subs_subs_id", "subcat_pyramid_id_3m"],
    )
    with_category = join_lookup(
        with_subscriber,
        dims.categories,
        "subcat_pyramid_id_3m",
        "subcat_pyramid_id",
        ["subcat_pyramid_name", "cat_pyramid_name"],
    )
    ts = "create_date"
    return (
        attach_flags(with_category, flags)
        .withColumns(
            {
                "snap_date": day_key(ts),
                "snap_week": week_start(ts),
                "snap_month": month_start(ts),
                "snap_quarter": quarter_start(ts),
            }
        )
        .withColumnRenamed("flag_indicator", "flag_local_general")
        .select(*INQUIRY_DAILY.fieldNames())
    )
