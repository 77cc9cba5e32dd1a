"""Aggregations, profiles, sorts and top-k reports."""

from __future__ import annotations

from datetime import date
from functools import partial

from pyspark.sql import functions as F

from tidemark.functions.scalars import age_bin
from tidemark.operators.correlation import column_correlation, correlations, daily_pairs, series_correlation
from tidemark.operators.profile import (
    box_statistics,
    density_curve,
    density_histogram,
    distinct_counts,
    frequencies,
    group_means,
    histogram,
    missing_share,
    null_counts,
    sorted_groups,
    table_shape,
    top_categories,
    top_groups,
)
from tidemark.operators.segments import group_daily
from tidemark.operators.series import daily_metric, day_range
from tidemark.operators.site_flags import cell_counts, flag_sums, with_flag, with_week_statistics
from tidemark.operators.joins import valid_as_of
from tidemark.plans.inquiry import counted_inquiries
from tidemark.plans.survey import prepare_survey, write_prepared
from tidemark.plans.vas import RULES, charge_filter, rule_sums, subscriber_days
from tidemark.registry import query, r6, s6
from tidemark.registry.standins import (
    AS_OF,
    CHARGES,
    COUNTS,
    END,
    FLAGS,
    LABELLED,
    LINES,
    LONG,
    START,
    SURVEY,
    charges,
    inquiries,
    inquiry_dimensions,
    labelled,
    lines,
    subscriber_orders,
    scratch,
    survey,
    table,
)


@query(
    "d1_daily_metric",
    f"WITH {LINES} SELECT day, {s6('avg(nps)')} AS metric, count(*) AS n_rows, count(nps) AS n_values FROM lines GROUP BY day",
)
def d1_daily_metric(spark, sf):
    return daily_metric(lines(spark, sf), "day", "nps").withColumn("metric", r6("metric"))


_FUNCS = {
    "mean": "avg(nps)",
    "size": "count(*)",
    "count": "count(nps)",
    "sum": "sum(nps)",
    "min": "min(nps)",
    "max": "max(nps)",
    "median": "median(nps)",
    "std": "stddev_samp(nps)",
    "nunique": "count(DISTINCT nps)",
}


@query(
    "d1_aggregate_registry",
    f"WITH {LINES} " + " UNION ALL ".join(
        f"SELECT '{n}' AS func, l_returnflag, {s6(f'CAST({e} AS DOUBLE)')} AS metric FROM lines GROUP BY l_returnflag"
        for n, e in _FUNCS.items()
    ),
)
def d1_aggregate_registry(spark, sf):
    """Every aggregate name on one grouping."""
    df = lines(spark, sf)
    out = None
    for name in _FUNCS:
        part = daily_metric(df, "l_returnflag", "nps", name).select(
            F.lit(name).alias("func"), "l_returnflag", r6(F.col("metric").cast("double")).alias("metric")
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "d2_group_daily",
    f"""WITH {LONG} SELECT segment, grp AS "group", day, {s6("avg(nps)")} AS metric, count(*) AS n_rows, count(nps) AS n_values
    FROM long WHERE grp IS NOT NULL GROUP BY segment, grp, day""",
)
def d2_group_daily(spark, sf):
    return group_daily(survey(spark, sf), "day", "nps").withColumn("metric", r6("metric"))


@query(
    "d3_size_and_count",
    f"WITH {LABELLED} SELECT source, count(*) AS n_rows, count(quality) AS n_values FROM labelled GROUP BY source",
)
def d3_size_and_count(spark, sf):
    return daily_metric(labelled(spark, sf), "source", "quality", "size").select("source", "n_rows", "n_values")


def _counts(spark, sf):
    dims = inquiry_dimensions(spark, sf)
    return cell_counts(
        counted_inquiries(inquiries(spark, sf), START, END),
        valid_as_of(dims.cells, AS_OF),
        valid_as_of(dims.organisations, AS_OF),
    )


@query(
    "d4_cell_day_counts",
    f"WITH {COUNTS} SELECT CAST(os_os_id AS BIGINT) AS os_os_id, sk_bmt_id, year, month, week, day, c FROM counts",
)
def d4_cell_day_counts(spark, sf):
    return _counts(spark, sf)


# Fixed values, written out here as well so that a wrong id in the plan shows.
_MN = "detg_detg_id IN (30, 3379, 22) AND lcal_lcal_id IN (16, 17, 18, 19, 20, 21, 94)"
_GOR = "detg_detg_id IN (21, 30, 3383) AND lcal_lcal_id IN (7, 14, 15, 227, 228)"
_OPER = (
    "detg_detg_id IN (21, 30, 3383, 3380, 3381) AND lcal_lcal_id IN (6, 13, 225, 468, 469, 470, 471, 472, 473, 474, 475,"
    " 476, 477, 478, 479, 480, 481, 482, 483, 484, 485, 486, 505, 506, 507, 508, 509, 510)"
)
_SMS = (
    "detg_detg_id IN (25, 32, 42) AND lcal_lcal_id IN (23, 24, 26, 27, 28, 29, 30, 31, 33, 34, 36, 552, 553, 554, 555,"
    " 556, 487, 488, 489, 490, 491, 492, 493, 494, 495, 496, 497, 498, 499, 500, 501, 502, 503, 504)"
)
RULE_SQL = ", ".join(
    f"CAST(sum(CASE WHEN {condition} THEN {value} ELSE 0 END) AS DOUBLE) AS {name}"
    for name, condition, value in (
        ("product_perepl_mn", _MN, "amount"),
        ("product_perepl_gor", _GOR, "amount"),
        ("product_perepl_oper", _OPER, "amount"),
        ("product_perepl_sms", _SMS, "amount"),
        ("product_uderzh", "vas_vas_id = 10600078", "revenue"),
        ("product_kz", "vas_vas_id = 10600050", "revenue"),
        ("product_gpya", "vas_vas_id = 10600045", "revenue"),
        ("product_zkz", "vas_vas_id = 10600095", "revenue"),
    )
)
CHARGE_SQL = (
    "(vas_vas_id IN (10600078, 10600050, 10600045, 10600095)"
    " OR detg_detg_id IN (30, 3379, 22, 21, 3383, 3380, 3381, 25, 32, 42))"
)


@query(
    "d5_conditional_sums",
    f"WITH {CHARGES} SELECT sk_subs_id, {RULE_SQL} FROM charges WHERE {CHARGE_SQL} GROUP BY sk_subs_id",
)
def d5_conditional_sums(spark, sf):
    sums = charges(spark, sf).where(charge_filter(RULES)).groupBy("sk_subs_id").agg(*rule_sums(RULES))
    return sums.select("sk_subs_id", *[F.col(n).cast("double").alias(n) for n in RULES])


@query(
    "d6_flag_sums",
    f"""WITH {FLAGS} SELECT CAST(os_os_id AS BIGINT) AS os_os_id, sk_bmt_id, year, month, week, day,
      CAST(sum(flag_indicator) AS BIGINT) AS flag_indicator FROM flags GROUP BY ALL""",
)
def d6_flag_sums(spark, sf):
    return flag_sums(with_flag(with_week_statistics(_counts(spark, sf))))


@query(
    "d7_distinct_rows",
    f"WITH {CHARGES} SELECT sk_subs_id, snap_date, snap_month FROM days",
)
def d7_distinct_rows(spark, sf):
    return subscriber_days(subscriber_orders(spark, sf), date(1995, 1, 1), date(2100, 1, 1))


_NULLABLE = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@query(
    "d8_missing_share",
    f"WITH {LABELLED}, shares AS ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", 100.0 * (count(*) - count({c})) / count(*) AS p FROM labelled""" for c in _NULLABLE
    )
    + f""") SELECT "column", {s6("p")} AS missing_percent FROM shares WHERE p > 0""",
)
def d8_missing_share(spark, sf):
    return missing_share(labelled(spark, sf)).withColumn("missing_percent", r6("missing_percent"))


@query(
    "d9_null_counts",
    f"WITH {LABELLED} "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_null FROM labelled""" for c in _NULLABLE
    ),
)
def d9_null_counts(spark, sf):
    return null_counts(labelled(spark, sf))


@query("d9_table_shape", "SELECT count(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns FROM documents")
def d9_table_shape(spark, sf):
    return table_shape(labelled(spark, sf))


@query(
    "d9_preparation_report",
    f"""WITH {LINES}, counts AS (SELECT count(*) AS n, count_if(l_quantity = 13 AND l_returnflag = 'R') AS gaps FROM lines)
    SELECT s.stage, s.item AS "column", n AS n_rows, CASE WHEN s.stage = 'before' AND s.item = 'l_quantity' THEN CAST(gaps AS BIGINT) ELSE 0 END AS n_null, s.n_columns
    FROM counts, (SELECT 'before' AS stage, unnest(['l_orderkey', 'l_linenumber', 'snap_date', 'value_1', 'value_2', 'l_returnflag', 'l_quantity']) AS item, CAST(7 AS BIGINT) AS n_columns
      UNION ALL SELECT 'after', unnest(['l_returnflag', 'l_quantity', 'nps', 'snap_date_day']), 4) s""",
)
def d9_preparation_report(spark, sf):
    """Rows and gaps of each column before and after a preparation, observed while its result is written."""
    quantity = F.when((F.col("l_quantity") != 13) | (F.col("l_returnflag") != "R"), F.col("l_quantity")).alias("l_quantity")
    raw = lines(spark, sf).select("l_orderkey", "l_linenumber", F.col("l_shipdate").alias("snap_date"), F.col("a").alias("value_1"), F.col("b").alias("value_2"), "l_returnflag", quantity)
    prepare = partial(prepare_survey, key=["l_orderkey", "l_linenumber"], segments=["l_returnflag", "l_quantity"], ages={})
    _, report = write_prepared(raw, prepare, scratch(spark, "prepared"))
    return report


@query("d10_frequencies", "SELECT event_type AS value, count(*) AS n FROM events GROUP BY event_type")
def d10_frequencies(spark, sf):
    return frequencies(table(spark, sf, "events"), "event_type")


@query(
    "d11_distinct_counts",
    """SELECT 'user_id' AS "column", count(DISTINCT user_id) AS n_distinct FROM events
    UNION ALL SELECT 'event_type', count(DISTINCT event_type) FROM events
    UNION ALL SELECT 'value', count(DISTINCT value) FROM events""",
)
def d11_distinct_counts(spark, sf):
    return distinct_counts(table(spark, sf, "events"), ["user_id", "event_type", "value"])


@query("d12_group_means", f"WITH {SURVEY} SELECT p_brand, {s6('avg(nps)')} AS mean FROM survey GROUP BY p_brand")
def d12_group_means(spark, sf):
    return group_means(survey(spark, sf), "p_brand", "nps").withColumn("mean", r6("mean"))


def _box_sql(source, group, metric):
    return f"""q AS (SELECT {group}, count({metric}) AS n, quantile_cont({metric}, 0.25) AS q1, quantile_cont({metric}, 0.5) AS median,
      quantile_cont({metric}, 0.75) AS q3 FROM {source} WHERE {group} IS NOT NULL AND {metric} IS NOT NULL GROUP BY {group})
    SELECT s.{group}, any_value(n) AS n, {s6("any_value(q1)")} AS q1, {s6("any_value(q.median)")} AS median, {s6("any_value(q3)")} AS q3,
      {s6(f"min({metric})")} AS whisker_low, {s6(f"max({metric})")} AS whisker_high
    FROM {source} s JOIN q ON s.{group} = q.{group}
    WHERE s.{metric} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY s.{group}"""


def _rounded_box(df, group):
    return df.select(group, "n", *[r6(c).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")])


@query("d13_box_statistics", f"WITH {SURVEY}, {_box_sql('survey', 'p_brand', 'nps')}")
def d13_box_statistics(spark, sf):
    return _rounded_box(box_statistics(survey(spark, sf), "p_brand", "nps"), "p_brand")


AGED = f"""{LINES}, aged AS (
  SELECT nps, CASE WHEN age >= 55 THEN '55+' WHEN age >= 45 THEN '45-54' WHEN age >= 35 THEN '35-44'
    WHEN age >= 25 THEN '25-34' WHEN age >= 18 THEN '18-24' END AS age_group
  FROM (SELECT l.nps, p.p_size + 17 AS age FROM lines l JOIN part p ON l.l_partkey = p.p_partkey))"""


@query("d13_box_by_age", f"WITH {AGED}, {_box_sql('aged', 'age_group', 'nps')}")
def d13_box_by_age(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", age_bin(F.col("p_size") + 17).alias("age_group"))
    aged = lines(spark, sf).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return _rounded_box(box_statistics(aged, "age_group", "nps"), "age_group")


def _histogram_sql(source, columns, bins=30, min_distinct=15):
    long = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL""" for c in columns
    )
    return f"""hv AS ({long}), hr AS (SELECT "column", min(v) AS lo, max(v) AS hi FROM hv GROUP BY "column" HAVING count(DISTINCT v) > {min_distinct}),
    hw AS (SELECT hv."column", v, lo, (hi - lo) / {bins} AS width FROM hv JOIN hr ON hv."column" = hr."column")
    SELECT "column", CAST(least(floor((v - lo) / width), {bins - 1}) AS INTEGER) AS bin, lo, width, count(*) AS n FROM hw GROUP BY ALL"""


@query(
    "d14_histogram",
    f"""WITH h AS (WITH {_histogram_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])})
    SELECT "column", bin, {s6("lo + bin * width", 4)} AS bin_start, {s6("lo + (bin + 1) * width", 4)} AS bin_end, n FROM h""",
)
def d14_histogram(spark, sf):
    df = histogram(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_linenumber"])
    return df.withColumns({"bin_start": r6("bin_start", 4), "bin_end": r6("bin_end", 4)})


@query(
    "d15_density_histogram",
    f"""WITH {SURVEY}, v AS (SELECT p_type, nps FROM survey WHERE nps IS NOT NULL),
    r AS (SELECT p_type, min(nps) AS lo, (max(nps) - min(nps)) / 30 AS width, count(*) AS total FROM v GROUP BY p_type),
    b AS (SELECT v.p_type, CAST(least(floor((nps - lo) / width), 29) AS INTEGER) AS bin, lo, width, total FROM v JOIN r ON v.p_type = r.p_type)
    SELECT p_type, bin, {s6("lo + bin * width")} AS bin_start, count(*) AS n, {s6("count(*) / (total * width)")} AS density
    FROM b GROUP BY p_type, bin, lo, width, total""",
)
def d15_density_histogram(spark, sf):
    df = density_histogram(survey(spark, sf), "p_type", "nps")
    return df.withColumns({"bin_start": r6("bin_start"), "density": r6("density")})


@query(
    "d16_density_curve",
    f"""WITH {LINES}, long AS (
      SELECT 'nps' AS "column", nps AS v FROM lines WHERE nps IS NOT NULL UNION ALL SELECT 'l_quantity', l_quantity FROM lines),
    s AS (SELECT "column", count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(count(*), -0.2) AS h FROM long GROUP BY "column"),
    k AS (SELECT "column", v, count(*) AS k FROM long GROUP BY "column", v),
    g AS (SELECT s.*, CAST(step AS INTEGER) AS step, lo + (hi - lo) * step / 199.0 AS x FROM s, range(200) t(step))
    SELECT g."column", step, {s6("x")} AS x, {s6("sum(k * exp(-0.5 * ((x - v) / h) * ((x - v) / h))) / (any_value(n) * any_value(h) * sqrt(2 * pi()))")} AS density
    FROM g JOIN k ON g."column" = k."column" GROUP BY g."column", step, x""",
)
def d16_density_curve(spark, sf):
    df = density_curve(lines(spark, sf), ["nps", "l_quantity"], exact=True)
    return df.withColumns({"x": r6("x"), "density": r6("density")})


def _curve_sql(source, columns):
    """Values shared out to 1592 cells, and the sum of the kernels of the cells' ends."""
    long = " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS v FROM {source} WHERE {c} IS NOT NULL""" for c in columns)
    return f"""cv AS ({long}),
    cs AS (SELECT "column", count(*) AS n, min(v) AS lo, max(v) AS hi, (max(v) - min(v)) / 1592 AS d, stddev_samp(v) * pow(count(*), -0.2) AS h FROM cv GROUP BY "column"),
    cp AS (SELECT cv."column", (v - lo) / d AS p, least(floor((v - lo) / d), 1591) AS a FROM cv JOIN cs ON cv."column" = cs."column"),
    cw AS (SELECT "column", a, sum(w) AS w FROM (SELECT "column", a, 1 - (p - a) AS w FROM cp UNION ALL SELECT "column", a + 1, p - a FROM cp) GROUP BY "column", a)
    SELECT cs."column", CAST(step AS INTEGER) AS step, lo + (hi - lo) * step / 199.0 AS x,
      sum(w * exp(-0.5 * pow((step * 8 - a) * d / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
    FROM cw JOIN cs ON cw."column" = cs."column", range(200) t(step) GROUP BY cs."column", step, lo, hi"""


@query(
    "d16_binned_curve",
    f"""WITH {LINES}, curve AS (WITH {_curve_sql("lines", ["nps", "l_quantity", "l_extendedprice"])})
    SELECT "column", step, {s6("x")} AS x, {s6("density", 9)} AS density FROM curve""",
)
def d16_binned_curve(spark, sf):
    df = density_curve(lines(spark, sf), ["nps", "l_quantity", "l_extendedprice"])
    return df.withColumns({"x": r6("x"), "density": r6("density", 9)})


@query("d17_day_range", f"WITH {LINES} SELECT min(day) AS min_day, max(day) AS max_day FROM lines")
def d17_day_range(spark, sf):
    return day_range(lines(spark, sf), "day")


PAIRS = f"""{LINES}, a AS (SELECT day, avg(nps) AS x FROM lines GROUP BY day),
b AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS y FROM orders GROUP BY ALL),
pairs AS (SELECT a.day, x, y FROM a JOIN b ON a.day = b.day WHERE x IS NOT NULL),
ranked AS (SELECT *, rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
  rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM pairs)"""


def _pairs(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    return daily_pairs(lines(spark, sf), orders, "day", "nps", "o_orderkey", "mean", "size")


@query("d18_pearson", f"WITH {PAIRS} SELECT count(*) AS n, {s6('corr(x, y)')} AS pearson FROM pairs")
def d18_pearson(spark, sf):
    return correlations(_pairs(spark, sf), "metric_1", "metric_2").select("n", r6("pearson").alias("pearson"))


@query("d19_spearman", f"WITH {PAIRS} SELECT count(*) AS n, {s6('corr(rx, ry)')} AS spearman FROM ranked")
def d19_spearman(spark, sf):
    return correlations(_pairs(spark, sf), "metric_1", "metric_2").select("n", r6("spearman").alias("spearman"))


@query(
    "d19_spearman_of_columns",
    f"""WITH r AS (SELECT l_quantity AS x, l_extendedprice AS y,
      rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS rx,
      rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS ry FROM lineitem)
    SELECT count(*) AS n, {s6("corr(x, y)")} AS pearson, {s6("corr(rx, ry)")} AS spearman FROM r""",
)
def d19_spearman_of_columns(spark, sf):
    """Two columns of the fact table, with many ties in one of them."""
    df = column_correlation(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return df.select("n", r6("pearson").alias("pearson"), r6("spearman").alias("spearman"))


_T = "r * sqrt((n - 2) / (1 - r * r))"


@query(
    "d20_t_statistics",
    f"""WITH {PAIRS}, p AS (SELECT count(*) AS n, corr(x, y) AS r FROM ranked), s AS (SELECT count(*) AS n, corr(rx, ry) AS r FROM ranked)
    SELECT p.n, (SELECT {s6(_T)} FROM p) AS pearson_t, (SELECT {s6(_T)} FROM s) AS spearman_t FROM p""",
)
def d20_t_statistics(spark, sf):
    df = correlations(_pairs(spark, sf), "metric_1", "metric_2")
    return df.select("n", r6("pearson_t").alias("pearson_t"), r6("spearman_t").alias("spearman_t"))


def _p_sql(t):
    """Both tails of Student's density beyond t, by the midpoint rule after x = t + u / (1 - u)."""
    density = f"exp(lgamma((v + 1) / 2) - lgamma(v / 2) - 0.5 * ln(v * pi()) - (v + 1) / 2 * ln(1 + pow({t} + u / (1 - u), 2) / v))"
    return s6(f"2 * sum({density} / pow(1 - u, 2)) / 20000", 4)


@query(
    "d20_p_values",
    f"""WITH {PAIRS}, r AS (SELECT count(*) AS n, corr(x, y) AS p, corr(rx, ry) AS s FROM ranked),
    t AS (SELECT n, n - 2.0 AS v, abs(p) * sqrt((n - 2) / (1 - p * p)) AS tp, abs(s) * sqrt((n - 2) / (1 - s * s)) AS ts FROM r),
    steps AS (SELECT (i + 0.5) / 20000 AS u FROM range(20000) x(i))
    SELECT n, {_p_sql("tp")} AS pearson_p, {_p_sql("ts")} AS spearman_p FROM t, steps GROUP BY n""",
)
def d20_p_values(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    df = series_correlation(lines(spark, sf), orders, "day", "nps", "o_orderkey")
    return df.select("n", r6("pearson_p", 4).alias("pearson_p"), r6("spearman_p", 4).alias("spearman_p"))


@query(
    "f1_sort_by_aggregate",
    f"WITH {SURVEY} SELECT o_orderpriority, {s6('avg(nps)')} AS mean FROM survey GROUP BY o_orderpriority",
)
def f1_sort_by_aggregate(spark, sf):
    return group_means(survey(spark, sf), "o_orderpriority", "nps").withColumn("mean", r6("mean"))


@query(
    "f2_top_groups",
    f"WITH {SURVEY} SELECT p_brand, {s6('avg(nps)')} AS mean FROM survey GROUP BY p_brand ORDER BY avg(nps) DESC, p_brand LIMIT 10",
)
def f2_top_groups(spark, sf):
    return top_groups(survey(spark, sf), "p_brand", "nps", 10).withColumn("mean", r6("mean"))


_TOP = """SELECT "column", value, n, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS place FROM freq) WHERE place <= 15"""


@query(
    "f3_top_categories",
    f"""WITH freq AS (SELECT 'source' AS "column", source AS value, count(*) AS n FROM documents GROUP BY source
      UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang
      UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR), count(*) FROM documents GROUP BY n_chars) {_TOP}""",
)
def f3_top_categories(spark, sf):
    return top_categories(table(spark, sf, "documents"), ["source", "lang", "n_chars"])


@query("f4_sorted_groups", "SELECT DISTINCT p_brand FROM part WHERE p_brand IS NOT NULL")
def f4_sorted_groups(spark, sf):
    return sorted_groups(table(spark, sf, "part"), "p_brand")
