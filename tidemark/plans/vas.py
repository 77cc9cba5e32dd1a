"""Charges for paid services per subscriber and inquiry day, eight measures from a rule table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import shift_month_start, within_period


@dataclass(frozen=True)
class ChargeRule:
    """Charges counted by a measure: service ids, or charge ids together with call types."""

    value: str = "amount"
    charges: tuple[int, ...] = ()
    call_types: tuple[int, ...] = ()
    services: tuple[int, ...] = ()

    def condition(self) -> Column:
        if self.services:
            return F.col("vas_vas_id").isin(*self.services)
        return F.col("detg_detg_id").isin(*self.charges) & F.col("lcal_lcal_id").isin(*self.call_types)


# Charge, call type and service ids of the eight measures.
RULES: dict[str, ChargeRule] = {
    "product_perepl_mn": ChargeRule(charges=(30, 3379, 22), call_types=(16, 17, 18, 19, 20, 21, 94)),
    "product_perepl_gor": ChargeRule(charges=(21, 30, 3383), call_types=(7, 14, 15, 227, 228)),
    "product_perepl_oper": ChargeRule(
        charges=(21, 30, 3383, 3380, 3381),
        call_types=(
            6, 13, 225, 468, 469, 470, 471, 472, 473, 474, 475, 476, 477, 478, 479,
            480, 481, 482, 483, 484, 485, 486, 505, 506, 507, 508, 509, 510,
        ),
    ),
    "product_perepl_sms": ChargeRule(
        charges=(25, 32, 42),
        call_types=(
            23, 24, 26, 27, 28, 29, 30, 31, 33, 34, 36,
            552, 553, 554, 555, 556,
            487, 488, 489, 490, 491, 492, 493, 494, 495, 496,
            497, 498, 499, 500, 501, 502, 503, 504,
        ),
    ),
    "product_uderzh": ChargeRule(value="revenue", services=(10600078,)),
    "product_kz": ChargeRule(value="revenue", services=(10600050,)),
    "product_gpya": ChargeRule(value="revenue", services=(10600045,)),
    "product_zkz": ChargeRule(value="revenue", services=(10600095,)),
}
BILLING_BRANCH = 10


def rule_sums(rules: Mapping[str, ChargeRule]) -> list[Column]:
    """One conditional sum per rule; charges outside the rule count as 0."""
    return [
        F.sum(F.when(r.condition(), F.col(r.value)).otherwise(F.lit(0))).alias(name) for name, r in rules.items()
    ]


def charge_filter(rules: Mapping[str, ChargeRule]) -> Column:
    """Any id that a rule names; charge ids are matched without their call types."""
    services = sorted({s for r in rules.values() for s in r.services})
    charges = sorted({c for r in rules.values() for c in r.charges})
    return F.col("vas_vas_id").isin(*services) | F.col("detg_detg_id").isin(*charges)


def subscriber_days(inquiries: DataFrame, start: date, end: date) -> DataFrame:
    """Distinct (subscriber, day, month) of the period."""
    return (
        inquiries.where(within_period("snap_date", start, end))
        .select("sk_subs_id", "snap_date", "snap_month")
        .distinct()
    )


def monthly_sums(
    charges: DataFrame, first: date, last: date, rules: Mapping[str, ChargeRule] = RULES, branch: int = BILLING_BRANCH
) -> DataFrame:
    """Measures per subscriber and month."""
    return (
        charges.where(
            (F.col("billing_filial_id") == branch) & within_period("start_date", first, last) & charge_filter(rules)
        )
        .groupBy("sk_subs_id", "start_date")
        .agg(*rule_sums(rules))
    )


def vas_usage(
    inquiries: DataFrame,
    charges: DataFrame,
    start: date,
    end: date,
    delta: int = -1,
    rules: Mapping[str, ChargeRule] = RULES,
    branch: int = BILLING_BRANCH,
) -> DataFrame:
    """Measures per subscriber and inquiry day from the month `delta` months away.

    The sums depend on the subscriber and the month alone, so charges are summed before the join: each
    subscriber-day then meets one row, and the charges of a subscriber are not repeated for every day.
    """
    first, last = (shift_month_start(d, delta) for d in (start, end))
    sums = monthly_sums(charges, first, last, rules, branch)
    days = subscriber_days(inquiries, start, end).withColumn("start_date", F.add_months("snap_month", delta))
    return days.join(sums, ["sk_subs_id", "start_date"]).select("sk_subs_id", "snap_date", "snap_month", *rules)
