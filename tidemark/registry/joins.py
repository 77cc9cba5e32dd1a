"""Joins of the fact loads."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tidemark.operators.correlation import daily_pairs
from tidemark.operators.joins import join_history, join_lookup, join_months_apart, join_snapshot, valid_as_of
from tidemark.operators.profile import rows_of_top_groups
from tidemark.operators.segments import group_daily
from tidemark.plans.detector import all_daily, base_series
from tidemark.plans.inquiry import TOPIC_COLUMNS, attach_flags, site_flags
from tidemark.plans.vas import subscriber_days
from tidemark.registry import query, r6, s6
from tidemark.registry.standins import (
    AS_OF,
    CHARGES,
    END,
    FLAGS,
    INQUIRIES,
    LINES,
    LONG,
    START,
    SURVEY,
    charges,
    inquiries,
    inquiry_dimensions,
    lines,
    subscriber_orders,
    survey,
    table,
)


@query(
    "c1_group_to_base",
    f"""WITH {LONG}, base AS (SELECT day, avg(nps) AS all_metric, count(*) AS total_count FROM survey GROUP BY day)
    SELECT l.segment, l.grp AS "group", l.day, {s6("avg(l.nps)")} AS metric, {s6("any_value(b.all_metric)")} AS metric_all,
      any_value(b.total_count) AS total_count
    FROM long l LEFT JOIN base b ON l.day = b.day WHERE l.grp IS NOT NULL GROUP BY l.segment, l.grp, l.day""",
)
def c1_group_to_base(spark, sf):
    df = survey(spark, sf)
    base = base_series(all_daily(df, "day", "nps", "mean", [])).withColumnRenamed("metric", "metric_all")
    groups = group_daily(df, "day", "nps")
    return groups.join(F.broadcast(base), "day", "left").select(
        "segment", "group", "day", r6("metric").alias("metric"), r6("metric_all").alias("metric_all"), "total_count"
    )


@query(
    "c2_join_daily_series",
    f"""WITH {LINES}, a AS (SELECT day, avg(nps) AS m FROM lines GROUP BY day),
    b AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY ALL)
    SELECT a.day, {s6("m")} AS metric_1, n AS metric_2 FROM a JOIN b ON a.day = b.day""",
)
def c2_join_daily_series(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    pairs = daily_pairs(lines(spark, sf), orders, "day", "nps", "o_orderkey", "mean", "size")
    return pairs.withColumn("metric_1", r6("metric_1"))


@query(
    "c3_history_join",
    f"""WITH {INQUIRIES} SELECT i.inqr_id, t.code_level_1, t.full_name FROM inq i
    LEFT JOIN topics t ON t.itpc_id = i.itpc_itpc_id AND t.billing_filial_id = i.billing_filial_id
      AND t.start_date <= DATE '2024-01-01' AND t.end_date > DATE '2024-02-01'""",
)
def c3_history_join(spark, sf):
    keys = [("itpc_itpc_id", "itpc_id"), ("billing_filial_id", "billing_filial_id")]
    topics = inquiry_dimensions(spark, sf).topics
    joined = join_history(inquiries(spark, sf), topics, keys, START, END, TOPIC_COLUMNS)
    return joined.select("inqr_id", "code_level_1", "full_name")


_SNAP = """LEFT JOIN snapshot s ON s.sk_subs_id = i.sk_subs_id AND s.snap_date = CAST(i.create_date AS DATE)
      AND s.snap_date >= DATE '2024-01-01' AND s.snap_date < DATE '2024-02-01'"""


def _with_snapshot(spark, sf):
    columns = ["filial_id", "subs_subs_id", "subcat_pyramid_id_3m"]
    snapshot = inquiry_dimensions(spark, sf).snapshot
    return join_snapshot(inquiries(spark, sf), snapshot, "sk_subs_id", "create_date", START, END, columns)


@query(
    "c4_snapshot_join",
    f"""WITH {INQUIRIES} SELECT i.inqr_id, CAST(s.filial_id AS BIGINT) AS filial_id, s.subs_subs_id FROM inq i {_SNAP}""",
)
def c4_snapshot_join(spark, sf):
    return _with_snapshot(spark, sf).select("inqr_id", "filial_id", "subs_subs_id")


@query(
    "c5_chained_lookup",
    f"""WITH {INQUIRIES} SELECT i.inqr_id, c.subcat_pyramid_name, c.cat_pyramid_name FROM inq i {_SNAP}
    LEFT JOIN categories c ON c.subcat_pyramid_id = s.subcat_pyramid_id_3m""",
)
def c5_chained_lookup(spark, sf):
    columns = ["subcat_pyramid_name", "cat_pyramid_name"]
    categories = inquiry_dimensions(spark, sf).categories
    joined = join_lookup(_with_snapshot(spark, sf), categories, "subcat_pyramid_id_3m", "subcat_pyramid_id", columns)
    return joined.select("inqr_id", *columns)


_ATTACH = """LEFT JOIN (SELECT os_os_id, sk_bmt_id, year, month, week, day, CAST(sum(flag_indicator) AS BIGINT) AS flag_indicator
      FROM flags GROUP BY ALL) f
    ON f.os_os_id = i.cr_os_os_id AND f.sk_bmt_id = i.sk_bmt_id AND f.os_os_id IS NOT NULL
      AND year(i.create_date) = f.year AND month(i.create_date) = f.month
      AND ceil(day(i.create_date) / 7.0) = f.week AND day(i.create_date) = f.day"""


@query("c6_flag_join", f"WITH {FLAGS} SELECT i.inqr_id, f.flag_indicator FROM inq i {_ATTACH}")
def c6_flag_join(spark, sf):
    facts = inquiries(spark, sf)
    flags = site_flags(facts, inquiry_dimensions(spark, sf), START, END, AS_OF)
    return attach_flags(facts, flags).select("inqr_id", "flag_indicator")


@query(
    "c7_valid_lookup",
    f"""WITH {INQUIRIES} SELECT i.inqr_id, CAST(c.os_os_id AS BIGINT) AS os_os_id FROM inq i
    LEFT JOIN cells c ON c.sk_bmt_id = i.sk_bmt_id AND c.end_date > TIMESTAMP '2024-06-01'""",
)
def c7_valid_lookup(spark, sf):
    cells = valid_as_of(inquiry_dimensions(spark, sf).cells, AS_OF)
    return join_lookup(inquiries(spark, sf), cells, "sk_bmt_id", "sk_bmt_id", ["os_os_id"]).select("inqr_id", "os_os_id")


@query(
    "c8_distinct_fanout",
    f"""WITH {INQUIRIES} SELECT i.cr_os_os_id, count(*) AS n FROM inq i
    LEFT JOIN (SELECT DISTINCT os_os_id, ro FROM organisations) o ON o.os_os_id = i.cr_os_os_id GROUP BY i.cr_os_os_id""",
)
def c8_distinct_fanout(spark, sf):
    distinct = inquiry_dimensions(spark, sf).organisations.select("os_os_id", "ro").dropDuplicates()
    joined = join_lookup(inquiries(spark, sf), distinct, "cr_os_os_id", "os_os_id", ["ro"])
    return joined.groupBy("cr_os_os_id").agg(F.count(F.lit(1)).alias("n"))


@query(
    "c9_months_apart",
    f"""WITH {CHARGES} SELECT d.sk_subs_id, d.snap_date, c.start_date, CAST(c.amount AS DOUBLE) AS amount
    FROM days d JOIN charges c ON c.sk_subs_id = d.sk_subs_id AND c.start_date = CAST(d.snap_month - INTERVAL 1 MONTH AS DATE)
    WHERE d.snap_date >= DATE '1995-01-01' AND d.snap_date < DATE '2002-01-01'""",
)
def c9_months_apart(spark, sf):
    days = subscriber_days(subscriber_orders(spark, sf), date(1995, 1, 1), date(2002, 1, 1))
    joined = join_months_apart(days, charges(spark, sf), "sk_subs_id", "snap_month", "start_date", -1)
    return joined.select("sk_subs_id", "snap_date", "start_date", F.col("amount").cast("double").alias("amount"))


@query(
    "c10_rows_of_top_groups",
    f"""WITH {SURVEY} SELECT day, p_brand, {s6("nps")} AS nps FROM survey WHERE p_brand IN (
      SELECT p_brand FROM survey GROUP BY p_brand ORDER BY avg(nps) DESC, p_brand LIMIT 10)""",
)
def c10_rows_of_top_groups(spark, sf):
    df = rows_of_top_groups(survey(spark, sf), "p_brand", "nps", 10)
    return df.select("day", "p_brand", r6("nps").alias("nps"))
