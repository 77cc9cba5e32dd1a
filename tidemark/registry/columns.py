"""Projections, filters and column lists."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.calendar import within_period
from tidemark.functions.scalars import as_category
from tidemark.operators.columns import drop_missing_metric, rows_of_group, select_available, select_required
from tidemark.operators.joins import valid_as_of
from tidemark.operators.profile import columns_of_type, null_counts
from tidemark.operators.segments import (
    columns_with_prefix,
    group_sizes,
    keep_large_groups,
    segment_columns,
    suffix_columns,
    to_long,
)
from tidemark.operators.series import daily_metric
from tidemark.plans.inquiry import counted_inquiries
from tidemark.registry import query, r6, s6
from tidemark.registry.standins import (
    END,
    IN_PERIOD,
    INQUIRIES,
    LABELLED,
    LINES,
    LONG,
    SEGMENTS,
    START,
    SURVEY,
    inquiries,
    inquiry_dimensions,
    labelled,
    lines,
    survey,
    table,
)


@query("b1_select_required", "SELECT o_custkey, o_orderkey, o_orderpriority FROM orders")
def b1_select_required(spark, sf):
    return select_required(table(spark, sf, "orders"), ["o_orderpriority", "o_orderkey", "o_custkey"])


@query("b2_select_available", "SELECT o_orderkey, o_orderpriority FROM orders")
def b2_select_available(spark, sf):
    return select_available(table(spark, sf, "orders"), ["o_orderkey", "network_volte", "o_orderpriority"])


@query(
    "b3_group_filter",
    f"WITH {SURVEY} SELECT day, {s6('nps')} AS nps, p_type FROM survey WHERE p_brand = 'Brand#7'",
)
def b3_group_filter(spark, sf):
    return rows_of_group(survey(spark, sf), "p_brand", "Brand#7").select("day", r6("nps").alias("nps"), "p_type")


@query(
    "b4_minimum_group_size",
    """SELECT segment, grp AS "group", n_rows FROM (
      SELECT 'source' AS segment, source AS grp, count(*) AS n_rows FROM documents GROUP BY source
      UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang) WHERE n_rows >= 60""",
)
def b4_minimum_group_size(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", "source", "lang")
    sizes = group_sizes(docs, "doc_id", "n_chars", ["source", "lang"])
    return keep_large_groups(sizes, 60)


@query("b5_half_open_period", f"WITH {INQUIRIES} SELECT inqr_id, sk_subs_id FROM inq WHERE {IN_PERIOD}")
def b5_half_open_period(spark, sf):
    return inquiries(spark, sf).where(within_period("create_date", START, END)).select("inqr_id", "sk_subs_id")


# The inquiry categories and the company of the load.
@query(
    "b6_predicates",
    f"""WITH {INQUIRIES} SELECT inqr_id, crcat_crcat_id FROM inq
    WHERE {IN_PERIOD} AND crcat_crcat_id IN (1, 3, 4, 6, 7, 8, 9, 10) AND crcat_crcat_id IS NOT NULL AND comp_os_id = 150""",
)
def b6_predicates(spark, sf):
    return counted_inquiries(inquiries(spark, sf), START, END).select("inqr_id", "crcat_crcat_id")


@query(
    "b7_valid_as_of",
    f"WITH {INQUIRIES} SELECT sk_bmt_id, os_os_id FROM cells WHERE end_date > TIMESTAMP '2024-06-01'",
)
def b7_valid_as_of(spark, sf):
    return valid_as_of(inquiry_dimensions(spark, sf).cells, datetime(2024, 6, 1)).select("sk_bmt_id", "os_os_id")


@query(
    "b8_suffix_columns",
    f"WITH {LINES} SELECT day, {s6('avg(nps)')} AS metric_all, count(*) AS n_rows_all FROM lines GROUP BY day",
)
def b8_suffix_columns(spark, sf):
    daily = daily_metric(lines(spark, sf), "day", "nps").select("day", r6("metric").alias("metric"), "n_rows")
    return suffix_columns(daily, "all", ["day"])


@query(
    "b9_drop_helpers",
    f"WITH {LINES} SELECT day, {s6('avg(nps)')} AS metric FROM lines GROUP BY day",
)
def b9_drop_helpers(spark, sf):
    return daily_metric(lines(spark, sf), "day", "nps").drop("n_rows", "n_values").withColumn("metric", r6("metric"))


@query(
    "b10_columns_by_type",
    """SELECT 'n_chars' AS "column", count(*) AS n_rows, count(*) - count(n_chars) AS n_null FROM documents
    UNION ALL SELECT 'doc_id', count(*), count(*) - count(doc_id) FROM documents""",
)
def b10_columns_by_type(spark, sf):
    docs = table(spark, sf, "documents")
    return null_counts(docs, columns_of_type(docs, "numeric"))


@query(
    "b11_drop_missing_metric",
    f"WITH {LINES} SELECT l_orderkey, l_linenumber, {s6('nps')} AS nps FROM lines WHERE nps IS NOT NULL",
)
def b11_drop_missing_metric(spark, sf):
    df = drop_missing_metric(lines(spark, sf), "nps")
    return df.select("l_orderkey", "l_linenumber", r6("nps").alias("nps"))


@query("b12_columns_by_prefix", "SELECT p_brand, p_name, p_partkey, p_retailprice, p_size, p_type FROM part")
def b12_columns_by_prefix(spark, sf):
    part = table(spark, sf, "part")
    return part.select(*columns_with_prefix(part, "p_"))


@query(
    "g1_segment_columns",
    f"""WITH {LONG} SELECT segment, count(DISTINCT grp) AS n_groups FROM long WHERE grp IS NOT NULL GROUP BY segment""",
)
def g1_segment_columns(spark, sf):
    """Segments are all columns but the day and the metric."""
    df = survey(spark, sf)
    assert segment_columns(df, "day", "nps") == sorted(SEGMENTS)
    return to_long(df, "day", "nps").groupBy("segment").agg(F.count_distinct("group").alias("n_groups"))


@query(
    "h14_as_category",
    f"WITH {LABELLED} SELECT doc_id, CAST(quality AS VARCHAR) AS quality FROM labelled",
)
def h14_as_category(spark, sf):
    return labelled(spark, sf).select("doc_id", as_category("quality").alias("quality"))
