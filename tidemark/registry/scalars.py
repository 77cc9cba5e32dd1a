"""Scalar expressions on whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.functions import calendar as cal
from tidemark.functions import scalars as sc
from tidemark.operators.ranking import category_codes, decode, encode
from tidemark.registry import query, r6, s6
from tidemark.registry.standins import INQUIRIES, LABELLED, LINES, labelled, lines, table


def _events(spark, sf):
    return table(spark, sf, "events")


@query(
    "h1_clipped_ratio",
    f"""WITH {LINES} SELECT l_orderkey, l_linenumber, {s6('nps')} AS nps,
      CASE WHEN l_linenumber NOT IN (1, 2) THEN {s6('nps')} END AS nps_with_gaps FROM lines""",
)
def h1_clipped_ratio(spark, sf):
    """The ratio, and the same with NaN above the line in first rows and below it in second ones."""
    nan = F.lit(float("nan"))
    above, below = (F.when(F.col("l_linenumber") == n, nan).otherwise(F.col(c)) for n, c in ((1, "a"), (2, "b")))
    rows = lines(spark, sf).withColumn("gaps", sc.clipped_ratio(above, below))
    return rows.select("l_orderkey", "l_linenumber", r6("nps").alias("nps"), r6("gaps").alias("nps_with_gaps"))


@query(
    "h2_day_key",
    "SELECT event_id, CAST(ts AS DATE) AS day, strftime(ts, '%Y-%m-%d') AS day_text FROM events",
)
def h2_day_key(spark, sf):
    day = cal.day_key("ts")
    return _events(spark, sf).select("event_id", day.alias("day"), F.date_format(day, "yyyy-MM-dd").alias("day_text"))


@query(
    "h3_period_starts",
    """SELECT event_id, CAST(date_trunc('week', ts) AS DATE) AS snap_week, CAST(date_trunc('month', ts) AS DATE) AS snap_month,
      CAST(date_trunc('quarter', ts) AS DATE) AS snap_quarter FROM events""",
)
def h3_period_starts(spark, sf):
    return _events(spark, sf).select(
        "event_id",
        cal.week_start("ts").alias("snap_week"),
        cal.month_start("ts").alias("snap_month"),
        cal.quarter_start("ts").alias("snap_quarter"),
    )


@query(
    "h4_calendar_numbers",
    """SELECT o_orderkey, CAST(week(o_orderdate) AS INTEGER) AS snap_week, CAST(month(o_orderdate) AS INTEGER) AS snap_month,
      CAST(quarter(o_orderdate) AS INTEGER) AS snap_quarter, CAST(day(o_orderdate) AS INTEGER) AS survey_day FROM orders""",
)
def h4_calendar_numbers(spark, sf):
    df = table(spark, sf, "orders").withColumns(cal.calendar_columns("o_orderdate"))
    return df.select("o_orderkey", "snap_week", "snap_month", "snap_quarter", "survey_day")


_DAYS = "[" + ", ".join(f"'{d}'" for d in cal.WEEKDAYS) + "]"


@query(
    "h5_weekday",
    f"""SELECT o_orderkey, ({_DAYS})[CAST(isodow(o_orderdate) AS INTEGER)] AS survey_weekday,
      CASE WHEN isodow(o_orderdate) >= 6 THEN 'Выходной' ELSE 'Будний' END AS survey_weekday_type FROM orders""",
)
def h5_weekday(spark, sf):
    df = table(spark, sf, "orders").withColumns(cal.calendar_columns("o_orderdate"))
    return df.select("o_orderkey", "survey_weekday", "survey_weekday_type")


@query(
    "h6_time_group",
    """SELECT event_id, CASE WHEN hour(ts) < 6 OR hour(ts) >= 22 THEN 'Ночь' WHEN hour(ts) < 12 THEN 'Утро'
      WHEN hour(ts) < 18 THEN 'День' ELSE 'Вечер' END AS survey_time_group FROM events""",
)
def h6_time_group(spark, sf):
    return _events(spark, sf).select("event_id", cal.time_group("ts").alias("survey_time_group"))


@query(
    "h7_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
      CAST(ceil(day(ts) / 7.0) AS INTEGER) AS week, CAST(day(ts) AS INTEGER) AS day FROM events""",
)
def h7_date_parts(spark, sf):
    return _events(spark, sf).select(
        "event_id",
        F.year("ts").alias("year"),
        F.month("ts").alias("month"),
        cal.week_of_month("ts").alias("week"),
        F.dayofmonth("ts").alias("day"),
    )


@query(
    "h8_month_shift",
    """SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS previous_month,
      CAST(date_trunc('month', o_orderdate) + INTERVAL 11 MONTH AS DATE) AS eleven_later FROM orders""",
)
def h8_month_shift(spark, sf):
    first = cal.month_start("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", cal.shift_months(first, -1).alias("previous_month"), cal.shift_months(first, 11).alias("eleven_later")
    )


_AGE = "p_size + 17"


@query(
    "h9_age_band",
    f"""SELECT p_partkey, CASE WHEN {_AGE} >= 18 AND {_AGE} < 25 THEN '18-24' WHEN {_AGE} >= 25 AND {_AGE} < 35 THEN '25-34'
      WHEN {_AGE} >= 35 AND {_AGE} < 45 THEN '35-44' WHEN {_AGE} >= 45 AND {_AGE} < 55 THEN '45-54' WHEN {_AGE} > 55 THEN '55+'
      ELSE CAST({_AGE} AS VARCHAR) END AS age_group FROM part""",
)
def h9_age_band(spark, sf):
    return table(spark, sf, "part").select("p_partkey", sc.age_band(F.col("p_size") + 17).alias("age_group"))


@query(
    "h10_age_bin",
    """SELECT p_partkey, CASE WHEN p_size + 10 >= 55 THEN '55+' WHEN p_size + 10 >= 45 THEN '45-54' WHEN p_size + 10 >= 35 THEN '35-44'
      WHEN p_size + 10 >= 25 THEN '25-34' WHEN p_size + 10 >= 18 THEN '18-24' END AS age_group FROM part""",
)
def h10_age_bin(spark, sf):
    return table(spark, sf, "part").select("p_partkey", sc.age_bin(F.col("p_size") + 10).alias("age_group"))


@query(
    "h11_clip_and_infinity",
    f"""SELECT l_orderkey, l_linenumber, {s6('''greatest(-1.0, least(1.0, CASE WHEN l_tax = 0 THEN 0
      ELSE (l_discount - 0.05) / l_tax END))''')} AS clipped FROM lineitem""",
)
def h11_clip_and_infinity(spark, sf):
    infinite = F.when(F.col("l_tax") == 0, float("inf")).otherwise(F.try_divide(F.col("l_discount") - 0.05, F.col("l_tax")))
    df = table(spark, sf, "lineitem")
    return df.select("l_orderkey", "l_linenumber", r6(sc.clip(sc.infinite_to_zero(infinite), -1.0, 1.0)).alias("clipped"))


@query(
    "h12_near_zero",
    f"""SELECT l_orderkey, l_linenumber, {s6('''CASE WHEN abs(l_discount - 0.05) <= 1e-8 THEN 0
      ELSE l_quantity / (l_discount - 0.05) END''')} AS share FROM lineitem""",
)
def h12_near_zero(spark, sf):
    base = F.col("l_discount") - 0.05
    share = sc.zero_when_flat(base, sc.safe_divide(F.col("l_quantity"), base))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r6(share).alias("share"))


@query(
    "h13_safe_division",
    f"SELECT l_orderkey, l_linenumber, {s6('abs(l_discount - 0.05) / nullif(l_tax, 0)')} AS ratio FROM lineitem",
)
def h13_safe_division(spark, sf):
    ratio = sc.safe_divide(F.abs(F.col("l_discount") - 0.05), F.nullif(F.col("l_tax"), F.lit(0.0)))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", r6(ratio).alias("ratio"))


@query(
    "h15_placeholder",
    f"WITH {LABELLED} SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'missing') AS quality FROM labelled",
)
def h15_placeholder(spark, sf):
    return labelled(spark, sf).select("doc_id", sc.placeholder("quality").alias("quality"))


@query(
    "h16_category_codes",
    "SELECT c_name AS value, dense_rank() OVER (ORDER BY c_name) - 1 AS code FROM (SELECT DISTINCT c_name FROM customer)",
)
def h16_category_codes(spark, sf):
    return category_codes(table(spark, sf, "customer"), "c_name")


@query(
    "h16_encode_decode",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_brand) - 1 AS code, p_brand AS decoded FROM part""",
)
def h16_encode_decode(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    codes = category_codes(part, "p_brand")
    return decode(encode(part, "p_brand", codes, "code"), "code", codes, "decoded").select("p_partkey", "code", "decoded")


@query(
    "h17_text_tokens",
    "SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, split_part('g_' || c_mktsegment, '_', -1) AS token FROM customer",
)
def h17_text_tokens(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("trimmed"),
        sc.last_token(F.concat(F.lit("g_"), "c_mktsegment")).alias("token"),
    )


@query(
    "h18_conditional_value",
    f"WITH {INQUIRIES} SELECT inqr_id, CASE WHEN crcat_crcat_id IN (1, 3) THEN value ELSE 0 END AS amount FROM inq",
)
def h18_conditional_value(spark, sf):
    amount = F.when(F.col("event_type").isin("click", "purchase"), F.col("value")).otherwise(F.lit(0.0))
    return _events(spark, sf).select(F.col("event_id").alias("inqr_id"), amount.alias("amount"))
