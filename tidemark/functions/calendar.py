"""Calendar columns: day keys, period starts, bands of the day and the week."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (labels as they appear in the data).
TIME_GROUPS = ("Утро", "День", "Вечер", "Ночь")
WEEKDAYS = ("Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье")
WEEKDAY_TYPES = ("Будний", "Выходной")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_key(ts: str | Column) -> Column:
    """Day of a timestamp as a date."""
    return F.to_date(_col(ts))


def week_start(ts: str | Column) -> Column:
    """Monday of the ISO week."""
    return F.trunc(day_key(ts), "week")


def month_start(ts: str | Column) -> Column:
    return F.trunc(day_key(ts), "month")


def quarter_start(ts: str | Column) -> Column:
    return F.trunc(day_key(ts), "quarter")


def week_of_month(ts: str | Column) -> Column:
    """1 for days 1-7, 2 for days 8-14, up to 5."""
    return F.ceil(F.dayofmonth(_col(ts)) / F.lit(7)).cast("int")


def weekday_name(ts: str | Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAYS])
    return F.element_at(names, F.weekday(_col(ts)) + 1)


def weekday_type(ts: str | Column) -> Column:
    return F.when(F.weekday(_col(ts)) >= 5, WEEKDAY_TYPES[1]).otherwise(WEEKDAY_TYPES[0])


def time_group(ts: str | Column) -> Column:
    """Morning from 6, day from 12, evening from 18, night from 22."""
    hour = F.hour(_col(ts))
    morning, day, evening, night = TIME_GROUPS
    return (
        F.when((hour < 6) | (hour >= 22), night)
        .when(hour < 12, morning)
        .when(hour < 18, day)
        .when(hour < 22, evening)
    )


def shift_months(d: str | Column, delta: int) -> Column:
    """Month shift for month starts; other days keep their day number where it exists."""
    return F.add_months(_col(d), delta)


def shift_month_start(d: date, delta: int) -> date:
    """First day of the month `delta` months away from `d`."""
    months = d.year * 12 + d.month - 1 + delta
    return date(months // 12, months % 12 + 1, 1)


def within_period(c: str | Column, start: date, end: date) -> Column:
    """Half-open period: start inclusive, end exclusive. Pushed down to the scan as a range."""
    column = _col(c)
    return (column >= F.lit(start)) & (column < F.lit(end))


def calendar_columns(ts: str | Column) -> dict[str, Column]:
    """Week, month, quarter and day numbers with the named bands, ready for `withColumns`."""
    column = _col(ts)
    return {
        "snap_week": F.weekofyear(column),
        "snap_month": F.month(column),
        "snap_quarter": F.quarter(column),
        "survey_day": F.dayofmonth(column),
        "survey_time_group": time_group(column),
        "survey_weekday": weekday_name(column),
        "survey_weekday_type": weekday_type(column),
    }
