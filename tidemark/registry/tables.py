"""Sources and sinks."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.calendar import within_period
from tidemark.operators.segments import to_long, wide_names
from tidemark.plans.detector import detect_to_tables
from tidemark.plans.vas import vas_usage
from tidemark.registry import query, r6, s6
from tidemark.registry.aggregates import CHARGE_SQL, RULE_SQL
from tidemark.registry.detector_sql import DETECTOR, WINNERS
from tidemark.registry.standins import CHARGES, INQUIRIES, SEGMENTS, SURVEY, charges, inquiries, lines, scratch, subscriber_orders, survey, table
from tidemark.schemas import INQUIRY_SOURCE, VAS_MEASURES, VAS_USAGE
from tidemark.sources.sinks import create_table, reload_period, reload_table, write_processed
from tidemark.sources.versions import Store, reload_version
from tidemark.operators.profile import top_categories
from tidemark.sources.tables import (
    listed_segments,
    outside_dictionary,
    read_segment_dictionary,
    read_segment_list,
    read_table,
    read_warehouse,
)

RELOAD = date(1997, 1, 1), date(1997, 7, 1)


@query(
    "a1_read_table",
    f"""SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS status,
      CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS priority,
      CASE WHEN o_orderstatus <> 'P' THEN {s6("o_totalprice", 2)} END AS price FROM orders""",
)
def a1_read_table(spark, sf):
    """Orders written as delimited text with `nan` and empty cells, then read back."""
    path = scratch(spark, "orders.csv")
    table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "nan").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("o_orderstatus") == "P", float("nan")).otherwise(F.col("o_totalprice")).alias("price"),
    ).write.option("header", True).option("nanValue", "nan").csv(path)
    schema = "o_orderkey long, status string, priority string, price double"
    df = read_table(spark, path, spark.createDataFrame([], schema).schema, form="csv")
    return df.withColumn("price", r6("price", 2))


@query("a2_warehouse_scan", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def a2_warehouse_scan(spark, sf):
    return read_warehouse(spark, f"{sf}/customer.parquet", ["c_custkey", "c_nationkey", "c_mktsegment"])


_FRESH = """fresh AS (
  SELECT o_custkey AS sk_subs_id, CAST(o_orderdate AS DATE) AS snap_date, CAST(count(*) AS BIGINT) AS n
  FROM orders WHERE o_orderstatus = 'P' AND o_orderdate >= DATE '1997-01-01' AND o_orderdate < DATE '1997-07-01'
  GROUP BY ALL)"""
_RELOADED = f"""WITH {_FRESH}, existing AS (
  SELECT o_custkey AS sk_subs_id, CAST(o_orderdate AS DATE) AS snap_date, CAST(1 AS BIGINT) AS n FROM orders)
SELECT sk_subs_id, snap_date, n FROM existing WHERE NOT (snap_date >= DATE '1997-01-01' AND snap_date < DATE '1997-07-01')
UNION ALL SELECT sk_subs_id, snap_date, n FROM fresh"""


def _existing_and_fresh(spark, sf):
    existing = subscriber_orders(spark, sf).select("sk_subs_id", "snap_date", F.lit(1).cast("long").alias("n"))
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") == "P")
    fresh = (
        orders.select(F.col("o_custkey").alias("sk_subs_id"), F.to_date("o_orderdate").alias("snap_date"))
        .where((F.col("snap_date") >= F.lit(RELOAD[0])) & (F.col("snap_date") < F.lit(RELOAD[1])))
        .groupBy("sk_subs_id", "snap_date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return existing, fresh


@query("a3_reload_period", _RELOADED)
def a3_reload_period(spark, sf):
    existing, fresh = _existing_and_fresh(spark, sf)
    return reload_period(existing, fresh, *RELOAD)


@query("a3_reload_table", _RELOADED)
def a3_reload_table(spark, sf):
    """The same reload in place, on a table partitioned by month."""
    existing, fresh = (
        df.withColumn("snap_month", F.trunc("snap_date", "month")) for df in _existing_and_fresh(spark, sf)
    )
    path = scratch(spark, "reload")
    name = "reload_" + path[-32:]
    create_table(spark, name, existing.schema, "snap_month", path)
    reload_table(spark, name, existing, date(1900, 1, 1), date(2100, 1, 1), "snap_month")
    reload_table(spark, name, fresh, *RELOAD, "snap_month")
    return spark.table(name).select("sk_subs_id", "snap_date", "n")


@query("a3_reload_version", _RELOADED)
def a3_reload_version(spark, sf):
    """The same reload as one new version of a stored table, from a period that cuts a month."""
    existing, fresh = _existing_and_fresh(spark, sf)
    store = Store(spark, scratch(spark, "versions"))
    reload_version(store, "charges", existing, date(1900, 1, 1), date(2100, 1, 1))
    middle = date(1997, 4, 15)
    for start, end in ((RELOAD[0], middle), (middle, RELOAD[1])):
        reload_version(store, "charges", fresh.where(within_period("snap_date", start, end)), start, end)
    return store.read("charges")


@query(
    "a4_write_processed",
    f"WITH {SURVEY} SELECT day AS snap_date_day, {s6('nps')} AS nps, p_brand FROM survey",
)
def a4_write_processed(spark, sf):
    path = scratch(spark, "processed")
    df = survey(spark, sf).select(F.trunc("day", "month").alias("snap_month"), F.col("day").alias("snap_date_day"), "nps", "p_brand")
    write_processed(df, path, "snap_month")
    return read_table(spark, path).select("snap_date_day", r6("nps").alias("nps"), "p_brand")


@query(
    "a5_write_detector",
    f"""WITH {DETECTOR}, {WINNERS} SELECT s.day, s.segment, s.grp AS "group", {s6("s.z_score", 4)} AS z_score,
      {s6("s.contribution", 4)} AS contribution, {s6("s.z_score", 4)} AS wide_z_score, coalesce(w.ml_group = w.z_group AND w.ml_group = s.grp, false) AS winner
    FROM scored s JOIN winners w ON s.day = w.day AND s.segment = w.segment""",
)
def a5_write_detector(spark, sf):
    """The stored outputs of all segments put together again, with the wide export read back beside them."""
    path = scratch(spark, "detector")
    detect_to_tables(survey(spark, sf), path, "day", "nps", SEGMENTS, wide=True)
    z, contributions, significant = (spark.read.parquet(f"{path}/{t}") for t in ("z_scores", "contributions", "significant"))
    wide = []
    for number, (segment, names) in enumerate(wide_names(z, "z_score")):
        rows = spark.read.option("header", True).csv(f"{path}/z_scores_wide/{number:05d}")
        rows = rows.unpivot(["day"], names, "name", "wide_z_score").withColumn("segment", F.lit(segment))
        group = F.expr(f"substring(name, {len('z_score_' + segment + '_') + 1})")
        wide.append(rows.select(F.to_date("day").alias("day"), "segment", group.alias("group"), F.col("wide_z_score").cast("double").alias("wide_z_score")))
    key = ["day", "segment", "group"]
    rows = z.join(contributions, key).join(reduce(DataFrame.unionByName, wide), key, "left")
    rows = rows.join(significant.select("day", "segment", F.col("group").alias("_winner")), ["day", "segment"])
    return rows.select(*key, *[r6(c, 4).alias(c) for c in ("z_score", "contribution", "wide_z_score")], F.coalesce(F.col("_winner") == F.col("group"), F.lit(False)).alias("winner"))


@query(
    "a5_wide_significant",
    f"""WITH {DETECTOR}, {WINNERS} SELECT b.day, {s6("any_value(b.metric)")} AS metric, any_value(b.total_count) AS total_count,
      {s6("any_value(b.delta_all)")} AS delta_all, {", ".join(f"max(CASE WHEN w.segment = '{s}' AND w.ml_group = w.z_group THEN w.ml_group END) AS {s}" for s in SEGMENTS)}
    FROM base b LEFT JOIN winners w ON w.day = b.day GROUP BY b.day""",
)
def a5_wide_significant(spark, sf):
    """The stored main table with one column per segment, read back."""
    path = scratch(spark, "detector")
    detect_to_tables(survey(spark, sf), path, "day", "nps", SEGMENTS, wide=True)
    schema = "day date, metric double, total_count long, delta_all double, " + ", ".join(f"{s} string" for s in sorted(SEGMENTS))
    rows = read_table(spark, f"{path}/significant_wide", spark.createDataFrame([], schema).schema, form="csv")
    return rows.withColumns({"metric": r6("metric"), "delta_all": r6("delta_all")})


@query(
    "a6_table_definitions",
    f"""WITH {CHARGES} SELECT d.sk_subs_id, d.snap_date, d.snap_month, {RULE_SQL}
    FROM days d JOIN charges c ON c.sk_subs_id = d.sk_subs_id AND c.start_date = CAST(d.snap_month - INTERVAL 1 MONTH AS DATE)
    WHERE d.snap_date >= DATE '1997-01-01' AND d.snap_date < DATE '1997-07-01' AND c.billing_filial_id = 10 AND {CHARGE_SQL}
    GROUP BY d.sk_subs_id, d.snap_date, d.snap_month""",
)
def a6_table_definitions(spark, sf):
    """The result table of the charge load created from its schema and filled with one period, all measures stored."""
    path = scratch(spark, "vas")
    name = "vas_" + path[-32:]
    create_table(spark, name, VAS_USAGE, path=path)
    reload_table(spark, name, vas_usage(subscriber_orders(spark, sf), charges(spark, sf), *RELOAD), *RELOAD)
    return spark.table(name).withColumns({m: F.col(m).cast("double") for m in VAS_MEASURES})


@query(
    "a6_source_schema",
    f"""WITH {INQUIRIES} SELECT inqr_id, epoch_us(create_date) AS create_us, comp_os_id, billing_filial_id, itpc_itpc_id, sk_subs_id, sk_bmt_id,
      subs_os_os_id, cr_os_os_id, {s6("value / 10")} AS lat, {s6("value / 20")} AS lon, description, crcat_crcat_id FROM inq""",
)
def a6_source_schema(spark, sf):
    """Inquiries stored and read back under the declared source schema."""
    path = scratch(spark, "inquiries")
    inquiries(spark, sf).write.parquet(path)
    df = read_table(spark, path, INQUIRY_SOURCE).withColumn("create_us", F.unix_micros("create_date"))
    return df.drop("create_date", "cr_weight").withColumns({c: r6(F.col(c).cast("double")) for c in ("lat", "lon")})


def _dictionary_sql(known=""):
    return f"""dictionary AS (SELECT DISTINCT 'p_brand' AS segment, p_brand AS value FROM part {known and "WHERE p_brand <= 'Brand#20'"}
  UNION ALL SELECT DISTINCT 'p_size', CAST(p_size AS VARCHAR) FROM part {known and "WHERE p_size <= 40"})"""


def _dictionary_path(spark, sf, some=False):
    """Brands and sizes as a JSON object of lists; with `some` the dictionary does not know all of them."""
    part = table(spark, sf, "part")
    brands = part.where((F.col("p_brand") <= "Brand#20") | F.lit(not some)).agg(F.sort_array(F.collect_set("p_brand")).alias("p_brand"))
    sizes = part.where((F.col("p_size") <= 40) | F.lit(not some)).agg(
        F.sort_array(F.collect_set(F.col("p_size").cast("string"))).alias("p_size")
    )
    lists = brands.select(F.lit("p_brand").alias("k"), F.col("p_brand").alias("v")).unionByName(
        sizes.select(F.lit("p_size").alias("k"), F.col("p_size").alias("v"))
    )
    path = scratch(spark, "dictionary.json")
    lists.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "v"))))).coalesce(1).write.text(path)
    return path


@query("a7_segment_dictionary", f"WITH {_dictionary_sql()} SELECT segment, value FROM dictionary")
def a7_segment_dictionary(spark, sf):
    return read_segment_dictionary(spark, _dictionary_path(spark, sf)).select("segment", "value")


@query(
    "a7_segment_list",
    "SELECT DISTINCT p_brand AS segment FROM part",
)
def a7_segment_list(spark, sf):
    """One name per line with blanks around it, read back trimmed."""
    path = scratch(spark, "segments")
    names = table(spark, sf, "part").select("p_brand").distinct()
    names.select(F.concat(F.lit("  "), "p_brand", F.lit(" "))).write.text(path)
    return read_segment_list(spark, path)


@query(
    "a7_listed_categories",
    """SELECT 'p_brand' AS "column", p_brand AS value, count(*) AS n FROM part GROUP BY p_brand QUALIFY row_number() OVER (ORDER BY count(*) DESC, p_brand) <= 15
    UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY p_type QUALIFY row_number() OVER (ORDER BY count(*) DESC, p_type) <= 15""",
)
def a7_listed_categories(spark, sf):
    """A report over the segments that a list file names and the table has."""
    path = scratch(spark, "segments")
    table(spark, sf, "part").select(F.explode(F.array(*[F.lit(n) for n in (" p_brand", "p_type ", "", "unknown")]))).distinct().write.text(path)
    part = table(spark, sf, "part")
    return top_categories(part, listed_segments(part, read_segment_list(spark, path))).drop("place")


@query(
    "a7_outside_dictionary",
    f"""WITH {_dictionary_sql("some")}, long AS (
      SELECT 'p_brand' AS segment, p_brand AS g FROM part UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR) FROM part)
    SELECT l.segment, l.g AS "group", count(*) AS n FROM long l
    WHERE NOT EXISTS (SELECT 1 FROM dictionary d WHERE d.segment = l.segment AND d.value = l.g)
    GROUP BY l.segment, l.g""",
)
def a7_outside_dictionary(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_brand", "p_size")
    long = to_long(part, "p_partkey", "p_retailprice", ["p_brand", "p_size"])
    return outside_dictionary(long, read_segment_dictionary(spark, _dictionary_path(spark, sf, some=True)))


@query(
    "g2_replace_period",
    """SELECT CAST(l_shipdate AS DATE) AS snap_date, l_orderkey, l_linenumber FROM lineitem
    WHERE NOT (l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-07-01')
    UNION ALL SELECT CAST(l_shipdate AS DATE), l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate >= DATE '1997-01-01' AND l_shipdate < DATE '1997-07-01' AND l_returnflag = 'R'""",
)
def g2_replace_period(spark, sf):
    df = lines(spark, sf).select(F.col("day").alias("snap_date"), "l_orderkey", "l_linenumber", "l_returnflag")
    inside = (F.col("snap_date") >= F.lit(RELOAD[0])) & (F.col("snap_date") < F.lit(RELOAD[1]))
    fresh = df.where(inside & (F.col("l_returnflag") == "R"))
    return reload_period(df.drop("l_returnflag"), fresh.drop("l_returnflag"), *RELOAD)
