"""Window operators: series, rolling scores, week statistics and flags, winners."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.segments import significant_groups
from tidemark.operators.series import daily_metric, with_delta, with_rolling, with_rolling_score
from tidemark.operators.site_flags import with_flag, with_week_statistics
from tidemark.plans.detector import score_groups
from tidemark.registry import query, r6, s6
from tidemark.registry.aggregates import _counts
from tidemark.registry.detector_sql import DETECTOR, WINNERS
from tidemark.registry.standins import FLAGS, LINES, SEGMENTS, WEEK_STATS, lines, survey

DAILY = LINES + ", daily AS (SELECT day, avg(nps) AS metric, count(*) AS n_rows, count(nps) AS n_values FROM lines GROUP BY day)"
DELTA = (
    DAILY
    + """, diffs AS (SELECT *, metric - lag(metric) OVER (ORDER BY day) AS d FROM daily),
deltas AS (SELECT *, coalesce(d, first_value(d IGNORE NULLS) OVER (ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS delta FROM diffs)"""
)
_ROLL = "OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)"
SCORE = (
    DELTA
    + f""", rolled AS (SELECT *, avg(metric) {_ROLL} AS rolling_mean, stddev_samp(metric) {_ROLL} AS rolling_std FROM deltas)"""
)


def _daily(spark, sf):
    return daily_metric(lines(spark, sf), "day", "nps")


@query("e1_day_difference", f"WITH {DELTA} SELECT day, {s6('metric')} AS metric, {s6('delta')} AS delta FROM deltas")
def e1_day_difference(spark, sf):
    return with_delta(_daily(spark, sf), "day", "metric").select("day", r6("metric").alias("metric"), r6("delta").alias("delta"))


_GROUPED = (
    LINES
    + """, daily AS (SELECT l_suppkey, day, avg(nps) AS metric FROM lines GROUP BY l_suppkey, day),
diffs AS (SELECT *, metric - lag(metric) OVER (PARTITION BY l_suppkey ORDER BY day) AS d FROM daily)"""
)


@query(
    "e2_back_fill",
    f"""WITH {_GROUPED} SELECT l_suppkey, day, {s6('''first_value(d IGNORE NULLS) OVER (PARTITION BY l_suppkey ORDER BY day
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)''')} AS delta FROM diffs""",
)
def e2_back_fill(spark, sf):
    """Per supplier: days without a metric leave gaps inside the series."""
    daily = daily_metric(lines(spark, sf), "day", "nps", keys=["l_suppkey"])
    return with_delta(daily, "day", "metric", ["l_suppkey"]).select("l_suppkey", "day", r6("delta").alias("delta"))


@query(
    "e3_rolling_statistics",
    f"WITH {SCORE} SELECT day, {s6('rolling_mean')} AS rolling_mean, {s6('rolling_std')} AS rolling_std FROM rolled",
)
def e3_rolling_statistics(spark, sf):
    df = with_rolling(_daily(spark, sf), "day", "metric")
    return df.select("day", r6("rolling_mean").alias("rolling_mean"), r6("rolling_std").alias("rolling_std"))


_CALENDAR = "OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)"


@query(
    "e3_rolling_calendar",
    f"""WITH {DAILY} SELECT day, {s6(f'avg(metric) {_CALENDAR}')} AS rolling_mean,
      {s6(f'stddev_samp(metric) {_CALENDAR}')} AS rolling_std FROM daily""",
)
def e3_rolling_calendar(spark, sf):
    df = with_rolling(_daily(spark, sf), "day", "metric", calendar=True)
    return df.select("day", r6("rolling_mean").alias("rolling_mean"), r6("rolling_std").alias("rolling_std"))


@query(
    "e4_rolling_score",
    f"WITH {SCORE} SELECT day, {s6('(delta - rolling_mean) / (rolling_std + 1e-6)')} AS z_score FROM rolled",
)
def e4_rolling_score(spark, sf):
    df = with_rolling_score(with_delta(_daily(spark, sf), "day", "metric"), "day", "metric")
    return df.select("day", r6("z_score").alias("z_score"))


_KEYS = ["os_os_id", "sk_bmt_id", "year", "month", "week", "day", "c"]
_KEY_SQL = "CAST(os_os_id AS BIGINT) AS os_os_id, sk_bmt_id, year, month, week, day, c"


def _stats(spark, sf, *columns):
    df = with_week_statistics(_counts(spark, sf))
    return df.select(*_KEYS, *columns)


@query("e5_week_median", f"WITH {WEEK_STATS} SELECT {_KEY_SQL}, {s6('m')} AS m FROM stats")
def e5_week_median(spark, sf):
    return _stats(spark, sf, r6("m").alias("m"))


@query("e6_week_mean", f"WITH {WEEK_STATS} SELECT {_KEY_SQL}, {s6('sr')} AS sr FROM stats")
def e6_week_mean(spark, sf):
    return _stats(spark, sf, r6("sr").alias("sr"))


@query(
    "e7_week_extremes",
    f"WITH {WEEK_STATS} SELECT {_KEY_SQL}, c_maximum, c_minimum, c_maximum - c_minimum AS maxmin FROM stats",
)
def e7_week_extremes(spark, sf):
    return _stats(spark, sf, "c_maximum", "c_minimum", (F.col("c_maximum") - F.col("c_minimum")).alias("maxmin"))


@query("e8_deviation_median", f"WITH {WEEK_STATS} SELECT {_KEY_SQL}, {s6('mad')} AS mad FROM stats")
def e8_deviation_median(spark, sf):
    return _stats(spark, sf, r6("mad").alias("mad"))


@query("e9_modified_z", f"WITH {FLAGS} SELECT {_KEY_SQL}, {s6('z_modif')} AS z_modif FROM flags")
def e9_modified_z(spark, sf):
    df = with_flag(with_week_statistics(_counts(spark, sf)))
    return df.select(*_KEYS, r6("z_modif").alias("z_modif"))


@query("e10_anomaly_flag", f"WITH {FLAGS} SELECT {_KEY_SQL}, flag_indicator FROM flags")
def e10_anomaly_flag(spark, sf):
    return with_flag(with_week_statistics(_counts(spark, sf))).select(*_KEYS, "flag_indicator")


@query(
    "e11_excess",
    f"""WITH {FLAGS} SELECT {_KEY_SQL}, CAST(CASE WHEN flag_indicator = 1 THEN c - c_minimum ELSE 0 END AS BIGINT) AS excess_over_minimum,
      {s6("CASE WHEN flag_indicator = 1 THEN c - m ELSE 0 END")} AS excess_over_median FROM flags""",
)
def e11_excess(spark, sf):
    df = with_flag(with_week_statistics(_counts(spark, sf)))
    return df.select(*_KEYS, "excess_over_minimum", r6("excess_over_median").alias("excess_over_median"))


@query("e12_largest_contribution", f"WITH {DETECTOR}, {WINNERS} SELECT day, segment, ml_group, z_group FROM winners")
def e12_largest_contribution(spark, sf):
    scored = score_groups(survey(spark, sf), "day", "nps", "mean", SEGMENTS)
    return significant_groups(scored).select("day", "segment", "ml_group", "z_group")
