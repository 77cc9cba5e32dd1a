"""The test tables in the roles of the survey, inquiry and charge tables, in Spark and in SQL."""

from __future__ import annotations

import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import day_key
from tidemark.functions.scalars import clipped_ratio
from tidemark.plans.inquiry import InquiryDimensions
from tidemark.session import shared_folder

START, END = date(2024, 1, 1), date(2024, 2, 1)
AS_OF = datetime(2024, 6, 1)
SEGMENTS = ["l_linestatus", "l_returnflag", "o_orderpriority", "p_brand", "p_type"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# Survey answers: one per order line.
def lines(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "lineitem").withColumns(
        {"day": day_key("l_shipdate"), "a": F.col("l_discount") - F.lit(0.05), "b": F.col("l_tax")}
    )
    return df.withColumn("nps", clipped_ratio("a", "b"))


def survey(spark: SparkSession, sf: str) -> DataFrame:
    """(day, nps, five segments)."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines(spark, sf)
    joined = joined.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select("day", "nps", *SEGMENTS)


LINES = """lines AS (
  SELECT *, CAST(l_shipdate AS DATE) AS day, l_discount - 0.05 AS a, l_tax AS b,
    CASE WHEN l_tax <> 0 THEN greatest(-1.0, least(1.0, (l_discount - 0.05) / l_tax))
         WHEN l_discount - 0.05 > 0 THEN 1.0 WHEN l_discount - 0.05 < 0 THEN -1.0 END AS nps
  FROM lineitem)"""

SURVEY = (
    LINES
    + """, survey AS (
  SELECT l.day, l.nps, l.l_linestatus, l.l_returnflag, o.o_orderpriority, p.p_brand, p.p_type
  FROM lines l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""
)

LONG = (
    SURVEY
    + ", long AS ("
    + " UNION ALL ".join(f"SELECT day, nps, '{s}' AS segment, {s} AS grp FROM survey" for s in SEGMENTS)
    + ")"
)


# Documents with a label where there is one: the table with missing values.
def labelled(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    return docs.join(table(spark, sf, "labels"), "doc_id", "left")


LABELLED = """labelled AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, b.quality, b.toxic
  FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id)"""


# Inquiries: one per event, 25 cells on five sites.
EVENT_CODES = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 6}


def inquiries(spark: SparkSession, sf: str) -> DataFrame:
    code = F.coalesce(*[F.when(F.col("event_type") == n, F.lit(c)) for n, c in EVENT_CODES.items()], F.lit(7))
    cell = (code * 5 + F.pmod("user_id", F.lit(5))) % 25
    return table(spark, sf, "events").select(
        F.col("ts").alias("create_date"),
        F.lit(150).cast("long").alias("comp_os_id"),
        F.pmod("user_id", F.lit(5)).cast("long").alias("billing_filial_id"),
        F.pmod("user_id", F.lit(25)).cast("long").alias("itpc_itpc_id"),
        F.col("user_id").alias("sk_subs_id"),
        cell.cast("long").alias("sk_bmt_id"),
        F.pmod("user_id", F.lit(7)).cast("long").alias("subs_os_os_id"),
        (cell % 5).cast("long").alias("cr_os_os_id"),
        F.col("event_id").alias("inqr_id"),
        (F.col("value") / 10).cast("decimal(13,10)").alias("lat"),
        (F.col("value") / 20).cast("decimal(13,10)").alias("lon"),
        F.col("event_type").alias("description"),
        code.cast("long").alias("crcat_crcat_id"),
        F.lit(1).cast("decimal(4,2)").alias("cr_weight"),
    )


def inquiry_dimensions(spark: SparkSession, sf: str) -> InquiryDimensions:
    nation, customer, region = (table(spark, sf, n) for n in ("nation", "customer", "region"))
    far, past = F.lit(date(2999, 12, 31)), F.lit(date(2024, 1, 10))
    topics = nation.select(
        F.col("n_nationkey").cast("long").alias("itpc_id"),
        F.col("n_regionkey").cast("long").alias("billing_filial_id"),
        F.lit(date(2000, 1, 1)).alias("start_date"),
        F.when(F.col("n_regionkey") == 4, past).otherwise(far).alias("end_date"),
        F.col("n_name").alias("code_level_1"),
        F.concat(F.lit("L2 "), "n_name").alias("code_level_2"),
        F.concat(F.lit("L3 "), "n_name").alias("code_level_3"),
        F.lit(None).cast("string").alias("code_level_4"),
        F.concat_ws(" / ", F.lit("topic"), "n_name").alias("full_name"),
    )
    # Negative balances have no snapshot row.
    active = customer.where(F.col("c_acctbal") >= 0)
    days = table(spark, sf, "events").select("user_id", F.to_date("ts").alias("snap_date")).distinct()
    snapshot = days.join(active, F.col("user_id") == F.col("c_custkey")).select(
        F.col("user_id").alias("sk_subs_id"),
        "snap_date",
        F.col("c_nationkey").cast("long").alias("filial_id"),
        (F.col("c_custkey") + 1000000).alias("subs_subs_id"),
        F.pmod("c_nationkey", F.lit(6)).cast("long").alias("subcat_pyramid_id_3m"),
    )
    categories = region.select(
        F.col("r_regionkey").cast("long").alias("subcat_pyramid_id"),
        F.col("r_name").alias("subcat_pyramid_name"),
        F.concat(F.lit("cat "), "r_name").alias("cat_pyramid_name"),
    )
    valid_to = F.when(F.col("n_nationkey") == 24, F.lit(datetime(2024, 5, 1))).otherwise(F.lit(datetime(2999, 1, 1)))
    cells = nation.select(
        F.col("n_nationkey").cast("long").alias("sk_bmt_id"),
        F.col("n_regionkey").cast("long").alias("os_os_id"),
        valid_to.alias("end_date"),
    )
    open_end = F.lit(datetime(2999, 1, 1)).alias("end_date")
    second = nation.where(F.col("n_nationkey") == 7)
    organisations = region.select(F.col("r_regionkey").cast("long").alias("os_os_id"), F.col("r_name").alias("ro"), open_end).unionByName(
        second.select(F.col("n_regionkey").cast("long").alias("os_os_id"), F.col("n_name").alias("ro"), open_end)
    )
    return InquiryDimensions(topics, snapshot, categories, cells, organisations)


_CODE = "CASE event_type " + " ".join(f"WHEN '{n}' THEN {c}" for n, c in EVENT_CODES.items()) + " ELSE 7 END"

INQUIRIES = f"""inq AS (
  SELECT ts AS create_date, 150 AS comp_os_id, user_id % 5 AS billing_filial_id, user_id % 25 AS itpc_itpc_id,
    user_id AS sk_subs_id, ({_CODE} * 5 + user_id % 5) % 25 AS sk_bmt_id, user_id % 7 AS subs_os_os_id,
    (({_CODE} * 5 + user_id % 5) % 25) % 5 AS cr_os_os_id, event_id AS inqr_id, value,
    event_type AS description, {_CODE} AS crcat_crcat_id
  FROM events),
topics AS (
  SELECT n_nationkey AS itpc_id, n_regionkey AS billing_filial_id, DATE '2000-01-01' AS start_date,
    CASE WHEN n_regionkey = 4 THEN DATE '2024-01-10' ELSE DATE '2999-12-31' END AS end_date,
    n_name AS code_level_1, 'L2 ' || n_name AS code_level_2, 'L3 ' || n_name AS code_level_3,
    CAST(NULL AS VARCHAR) AS code_level_4, 'topic / ' || n_name AS full_name
  FROM nation),
snapshot AS (
  SELECT e.user_id AS sk_subs_id, e.snap_date, c.c_nationkey AS filial_id, c.c_custkey + 1000000 AS subs_subs_id,
    c.c_nationkey % 6 AS subcat_pyramid_id_3m
  FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS snap_date FROM events) e
  JOIN customer c ON e.user_id = c.c_custkey WHERE c.c_acctbal >= 0),
categories AS (
  SELECT r_regionkey AS subcat_pyramid_id, r_name AS subcat_pyramid_name, 'cat ' || r_name AS cat_pyramid_name
  FROM region),
cells AS (
  SELECT n_nationkey AS sk_bmt_id, n_regionkey AS os_os_id,
    CASE WHEN n_nationkey = 24 THEN TIMESTAMP '2024-05-01' ELSE TIMESTAMP '2999-01-01' END AS end_date
  FROM nation),
organisations AS (
  SELECT r_regionkey AS os_os_id, r_name AS ro, TIMESTAMP '2999-01-01' AS end_date FROM region
  UNION ALL
  SELECT n_regionkey, n_name, TIMESTAMP '2999-01-01' FROM nation WHERE n_nationkey = 7)"""

IN_PERIOD = "create_date >= TIMESTAMP '2024-01-01' AND create_date < TIMESTAMP '2024-02-01'"

# The inquiry categories that are counted.
COUNTS = (
    INQUIRIES
    + f""", counts AS (
  SELECT b.os_os_id, a.sk_bmt_id, CAST(year(create_date) AS INTEGER) AS year, CAST(month(create_date) AS INTEGER) AS month,
    CAST(ceil(day(create_date) / 7.0) AS INTEGER) AS week, CAST(day(create_date) AS INTEGER) AS day, count(*) AS c
  FROM inq a
  LEFT JOIN cells b ON a.sk_bmt_id = b.sk_bmt_id AND b.end_date > TIMESTAMP '2024-06-01'
  LEFT JOIN (SELECT DISTINCT os_os_id, ro FROM organisations WHERE end_date > TIMESTAMP '2024-06-01') o
    ON o.os_os_id = b.os_os_id
  WHERE crcat_crcat_id IN (1, 3, 4, 6, 7, 8, 9, 10) AND comp_os_id = 150 AND {IN_PERIOD}
  GROUP BY ALL)"""
)

# A second opinion on the windows of the code: one summary per cell and week, joined back to the days.
WEEK_STATS = (
    COUNTS
    + """, weekly AS (
  SELECT os_os_id, sk_bmt_id, year, month, week, median(c) AS m, avg(c) AS sr, max(c) AS c_maximum, min(c) AS c_minimum
  FROM counts GROUP BY os_os_id, sk_bmt_id, year, month, week),
days AS (
  SELECT c.*, w.m, w.sr, w.c_maximum, w.c_minimum FROM counts c
  JOIN weekly w ON c.os_os_id IS NOT DISTINCT FROM w.os_os_id AND c.sk_bmt_id IS NOT DISTINCT FROM w.sk_bmt_id
    AND c.year = w.year AND c.month = w.month AND c.week = w.week),
spread AS (
  SELECT os_os_id, sk_bmt_id, year, month, week, median(abs(c - sr)) AS mad
  FROM days GROUP BY os_os_id, sk_bmt_id, year, month, week),
stats AS (
  SELECT d.*, s.mad FROM days d
  JOIN spread s ON d.os_os_id IS NOT DISTINCT FROM s.os_os_id AND d.sk_bmt_id IS NOT DISTINCT FROM s.sk_bmt_id
    AND d.year = s.year AND d.month = s.month AND d.week = s.week)"""
)

FLAGS = (
    WEEK_STATS
    + """, flags AS (
  SELECT *, 0.6745 * abs(c - m) / nullif(mad, 0) AS z_modif, c_maximum - c_minimum AS maxmin,
    CAST(c_maximum - c_minimum >= 3 AND (c - c_minimum >= 10 OR coalesce(0.6745 * abs(c - m) > 3 * mad AND mad > 0, false))
      AS INTEGER) AS flag_indicator
  FROM stats)"""
)


# Charges: order lines billed to the customer of the order, by month.
def subscriber_orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("sk_subs_id"),
        F.to_date("o_orderdate").alias("snap_date"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("snap_month"),
    )


# Stand-in ids by line number, cycling through those the rules name, and one no rule names.
CHARGE_IDS = [30, 21, 3380, 25, 22, 42, 99]
CALL_TYPES = [16, 7, 468, 23, 228, 510, 94, 552, 6, 500]
SERVICE_IDS = [10600078, 10600050, 10600045, 10600095, 1, 2, 3, 4]


def _pick(ids: list[int], index) -> "F.Column":
    return F.element_at(F.array(*[F.lit(i) for i in ids]), (F.pmod(index, F.lit(len(ids))) + 1).cast("int")).cast("long")


def charges(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf, "part").select("p_partkey", "p_size")
    joined = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("o_custkey").alias("sk_subs_id"),
        F.when(F.col("l_returnflag") == "R", 20).otherwise(10).cast("long").alias("billing_filial_id"),
        F.trunc(F.to_date("o_orderdate"), "month").alias("start_date"),
        _pick(CHARGE_IDS, F.col("l_linenumber")).alias("detg_detg_id"),
        _pick(CALL_TYPES, F.col("p_size")).alias("lcal_lcal_id"),
        _pick(SERVICE_IDS, F.col("p_size")).alias("vas_vas_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        F.col("l_quantity").cast("decimal(18,2)").alias("revenue"),
    )


def _sql_list(ids: list[int]) -> str:
    return "[" + ", ".join(str(i) for i in ids) + "]"


CHARGES = f"""days AS (
  SELECT DISTINCT o_custkey AS sk_subs_id, CAST(o_orderdate AS DATE) AS snap_date,
    CAST(date_trunc('month', o_orderdate) AS DATE) AS snap_month
  FROM orders),
charges AS (
  SELECT o.o_custkey AS sk_subs_id, CASE WHEN l_returnflag = 'R' THEN 20 ELSE 10 END AS billing_filial_id,
    CAST(date_trunc('month', o.o_orderdate) AS DATE) AS start_date,
    ({_sql_list(CHARGE_IDS)})[CAST(l_linenumber % {len(CHARGE_IDS)} + 1 AS INTEGER)] AS detg_detg_id,
    ({_sql_list(CALL_TYPES)})[CAST(p_size % {len(CALL_TYPES)} + 1 AS INTEGER)] AS lcal_lcal_id,
    ({_sql_list(SERVICE_IDS)})[CAST(p_size % {len(SERVICE_IDS)} + 1 AS INTEGER)] AS vas_vas_id,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_quantity AS DECIMAL(18,2)) AS revenue
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)"""
