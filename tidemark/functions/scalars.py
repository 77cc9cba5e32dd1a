"""Scalar expressions: ratios, guards, bands and placeholders. ANSI mode stays on, so each division is guarded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NEAR_ZERO = 1e-8
AGE_BANDS = ((18, 25, "18-24"), (25, 35, "25-34"), (35, 45, "35-44"), (45, 55, "45-54"))
OLDEST_BAND = "55+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def clip(x: Column, low: float, high: float) -> Column:
    """Null and NaN give null; `greatest` and `least` alone would skip the one and take the other for the largest number."""
    return F.when(x.isNotNull() & ~F.isnan(x), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def clipped_ratio(a: str | Column, b: str | Column, low: float = -1.0, high: float = 1.0) -> Column:
    """a/b held inside [low, high]; a zero divisor gives the bound on the side of a, 0/0 and NaN on either side give null."""
    num, den = nan_to_null(_col(a)), nan_to_null(_col(b))
    return (
        F.when(den != 0, clip(num / den, low, high))
        .when((den == 0) & (num > 0), F.lit(high))
        .when((den == 0) & (num < 0), F.lit(low))
    )


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def infinite_to_zero(x: Column) -> Column:
    return F.when(F.abs(x) == float("inf"), F.lit(0.0)).otherwise(x)


def zero_when_flat(reference: Column, x: Column) -> Column:
    """0 where the reference value is as good as zero, x elsewhere."""
    return F.when(F.abs(reference) <= NEAR_ZERO, F.lit(0.0)).otherwise(x)


def age_band(age: str | Column, strict55: bool = True) -> Column:
    """Bands for analysis. With strict55 the age 55 and ages below 18 stay as the plain number."""
    a = _col(age)
    chain = None
    for low, high, label in AGE_BANDS:
        inside = (a >= low) & (a < high)
        chain = F.when(inside, label) if chain is None else chain.when(inside, label)
    chain = chain.when(a > 55 if strict55 else a >= 55, OLDEST_BAND)
    return chain.otherwise(a.cast("string"))


def age_bin(age: str | Column) -> Column:
    """Left-closed bins for plots; ages below 18 give null."""
    a = _col(age)
    chain = F.when(a >= 55, OLDEST_BAND)
    for low, _, label in reversed(AGE_BANDS):
        chain = chain.when(a >= low, label)
    return chain


def as_category(c: str | Column) -> Column:
    return _col(c).cast("string")


def placeholder(c: str | Column, text: str = "missing") -> Column:
    return F.coalesce(_col(c).cast("string"), F.lit(text))


#: Texts that readers of delimited files take for a missing value.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def text_null(c: str | Column, missing: Sequence[str] = MISSING_TEXTS) -> Column:
    """Null for the texts that mean a missing value."""
    column = _col(c)
    return F.when(~column.isin(*missing), column)


def last_token(c: str | Column, sep: str = "_") -> Column:
    return F.substring_index(_col(c), sep, -1)
