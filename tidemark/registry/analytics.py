"""Reshaping, imputation, detector, fact loads and reports."""

from __future__ import annotations

from dataclasses import replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.categories import category_impute, mode_impute, placeholder_impute
from tidemark.operators.isolation import isolation_score
from tidemark.operators.neighbours import knn_impute
from tidemark.operators.segments import group_daily, rolling_anomaly, to_long, to_wide, wide_names
from tidemark.operators.series import with_delta
from tidemark.plans.detector import score_groups, segment_anomalies
from tidemark.plans.incremental import reload_detector, start_detector, stored_anomalies
from tidemark.plans.inquiry import inquiry_daily
from tidemark.plans.profile_report import INQUIRY_COLUMNS, ProfileColumns, profile, report_rows
from tidemark.plans.survey import prepare_inquiry, prepare_survey
from tidemark.plans.vas import RULES, vas_usage
from tidemark.operators.correlation import series_correlation
from tidemark.registry import ORACLES, query, r6, s6
from tidemark.registry.aggregates import CHARGE_SQL, PAIRS, RULE_SQL, _box_sql, _curve_sql, _histogram_sql
from tidemark.registry.detector_sql import DETECTOR, WINNERS, detector
from tidemark.registry.joins import _ATTACH, _SNAP
from tidemark.registry.standins import (
    AS_OF,
    CHARGES,
    END,
    FLAGS,
    IN_PERIOD,
    LABELLED,
    LINES,
    LONG,
    SEGMENTS,
    START,
    charges,
    inquiries,
    inquiry_dimensions,
    labelled,
    lines,
    scratch,
    subscriber_orders,
    survey,
    table,
)
from tidemark.session import settled
from tidemark.sources.versions import Store


@query(
    "i1_long_form",
    f"""WITH {LONG} SELECT segment, grp AS "group", day, count(*) AS n FROM long WHERE grp IS NOT NULL GROUP BY segment, grp, day""",
)
def i1_long_form(spark, sf):
    return to_long(survey(spark, sf), "day", "nps").groupBy("segment", "group", "day").agg(F.count(F.lit(1)).alias("n"))


@query(
    "i2_wide_form",
    f"""WITH {LONG} SELECT day, 'metric_' || segment || '_' || grp AS name, {s6("avg(nps)")} AS metric
      FROM long WHERE grp IS NOT NULL GROUP BY day, segment, grp HAVING avg(nps) IS NOT NULL""",
)
def i2_wide_form(spark, sf):
    """All groups of all segments as columns, in blocks of 20, read back as rows."""
    daily = settled(group_daily(survey(spark, sf), "day", "nps", "mean", SEGMENTS).withColumn("metric", r6("metric")))
    blocks = [
        to_wide(daily.where(F.col("segment") == segment), "day", "metric", names).unpivot(["day"], names, "name", "metric")
        for segment, names in wide_names(daily, "metric", 20)
    ]
    return reduce(DataFrame.unionByName, blocks).where("metric IS NOT NULL")


def _knn_sql(source, key, columns, others="", k=5):
    """Brute force: every row with a gap against every row that has the value."""
    m = len(columns)
    shared = " + ".join(f"CASE WHEN r.{c} IS NOT NULL AND d.{c} IS NOT NULL THEN 1 ELSE 0 END" for c in columns)
    squares = " + ".join(f"coalesce(power(r.{c} - d.{c}, 2), 0)" for c in columns)
    found, joins, out = [], [], []
    for c in columns:
        found.append(
            f"""pair_{c} AS (SELECT r.{key} AS k, d.{key} AS dk, d.{c} AS v, ({shared}) AS p, ({squares}) AS q
  FROM {source} r JOIN {source} d ON r.{c} IS NULL AND d.{c} IS NOT NULL),
near_{c} AS (SELECT k, avg(v) AS f FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sqrt({m}.0 / p * q), dk) AS i
  FROM pair_{c} WHERE p > 0) WHERE i <= {k} GROUP BY k)"""
        )
        joins.append(f"LEFT JOIN near_{c} ON t.{key} = near_{c}.k")
        out.append(f"{s6(f'coalesce(t.{c}, near_{c}.f, (SELECT avg({c}) FROM {source}))', 4)} AS {c}")
    return f"{', '.join(found)} SELECT t.{key}{others}, {', '.join(out)} FROM {source} t {' '.join(joins)}"


@query(
    "j1_knn_impute",
    f"WITH {LABELLED}, {_knn_sql('labelled', 'doc_id', ['n_chars', 'quality', 'toxic'])}",
)
def j1_knn_impute(spark, sf):
    df = knn_impute(labelled(spark, sf).select("doc_id", "n_chars", "quality", "toxic"), "doc_id", ["n_chars", "quality", "toxic"])
    return df.select("doc_id", *[r6(c, 4).alias(c) for c in ("n_chars", "quality", "toxic")])


PART_GAPS = """gaps AS (
  SELECT p_partkey, CAST(nullif(p_size, 7) AS DOUBLE) AS p_size, CASE WHEN p_type <> 'PROMO' THEN p_retailprice END AS p_retailprice, q, d
  FROM part LEFT JOIN (SELECT l_partkey, round(avg(l_quantity) + CAST(2e-9 AS DOUBLE), 4) AS q,
      CASE WHEN avg(l_discount) < 0.0550123 THEN round(avg(l_discount) + CAST(2e-9 AS DOUBLE), 4) END AS d
    FROM lineitem GROUP BY l_partkey) ON p_partkey = l_partkey)"""


@query(
    "j1_knn_several_patterns",
    f"WITH {PART_GAPS}, {_knn_sql('gaps', 'p_partkey', ['p_size', 'p_retailprice', 'q', 'd'])}",
)
def j1_knn_several_patterns(spark, sf):
    """Four numbers per part with gaps in three of them: several patterns and dimensions."""
    sales = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.round(F.avg("l_quantity") + F.lit(2e-9), 4).alias("q"),
        F.when(F.avg("l_discount") < 0.0550123, F.round(F.avg("l_discount") + F.lit(2e-9), 4)).alias("d"),
    )
    part = table(spark, sf, "part").select(
        "p_partkey",
        F.nullif(F.col("p_size"), F.lit(7)).alias("p_size"),
        F.when(F.col("p_type") != "PROMO", F.col("p_retailprice")).alias("p_retailprice"),
    )
    df = part.join(sales, "p_partkey", "left")
    columns = ["p_size", "p_retailprice", "q", "d"]
    return knn_impute(df, "p_partkey", columns).select("p_partkey", *[r6(c, 4).alias(c) for c in columns])


@query(
    "j2_category_impute",
    f"""WITH {LABELLED} SELECT doc_id, CAST(quality AS VARCHAR) AS observed, true AS kept, true AS known_category FROM labelled""",
)
def j2_category_impute(spark, sf):
    """Every row: what was observed stays, and gaps get one of the observed categories."""
    df = labelled(spark, sf).select("doc_id", "lang", "source", "n_chars", F.col("quality").cast("string").alias("quality"))
    filled = category_impute(df, "quality", ["lang", "source", "n_chars"]).select("doc_id", F.col("quality").alias("_filled"))
    rows = df.join(filled, "doc_id")
    known = F.coalesce(F.col("_filled").isin("0", "1"), F.lit(False))
    return rows.select("doc_id", F.col("quality").alias("observed"), F.coalesce(F.col("quality") == F.col("_filled"), F.lit(True)).alias("kept"), known.alias("known_category"))


@query(
    "j2_category_rule",
    "SELECT doc_id, CASE lang WHEN 'en' THEN 'island' WHEN 'de' THEN 'centre' ELSE 'south' END AS region FROM documents",
)
def j2_category_rule(spark, sf):
    """A category that follows from the language, lost in a third of the rows: the forest finds it again."""
    region = F.when(F.col("lang") == "en", "island").when(F.col("lang") == "de", "centre").otherwise("south")
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars", F.when(F.col("doc_id") % 3 != 0, region).alias("region"))
    return category_impute(docs, "region", ["lang", "n_chars"]).select("doc_id", "region")


@query(
    "j3_placeholder_impute",
    f"""WITH {LABELLED} SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'missing') AS quality,
      coalesce(CAST(toxic AS VARCHAR), 'missing') AS toxic FROM labelled""",
)
def j3_placeholder_impute(spark, sf):
    return placeholder_impute(labelled(spark, sf).select("doc_id", "quality", "toxic"), ["quality", "toxic"])


@query(
    "j3_mode_impute",
    f"""WITH {LABELLED}, modes AS (SELECT source, q FROM (
      SELECT source, CAST(quality AS VARCHAR) AS q, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, quality) AS k
      FROM labelled WHERE quality IS NOT NULL GROUP BY source, quality) WHERE k = 1)
    SELECT doc_id, l.source, coalesce(CAST(quality AS VARCHAR), q) AS quality FROM labelled l LEFT JOIN modes m ON l.source = m.source""",
)
def j3_mode_impute(spark, sf):
    df = labelled(spark, sf).select("doc_id", "source", F.col("quality").cast("string").alias("quality"))
    return mode_impute(df, "quality", ["source"])


def _scored(spark, sf, **options):
    return score_groups(survey(spark, sf), "day", "nps", "mean", SEGMENTS, **options)


@query(
    "j4_isolation_score",
    f"""WITH {DETECTOR} SELECT segment, grp AS "group", day, {s6("depth", 4)} AS depth, ml_anomaly FROM scored""",
)
def j4_isolation_score(spark, sf):
    df = with_delta(group_daily(survey(spark, sf), "day", "nps"), "day", "metric", ["segment", "group"])
    scored = isolation_score(df, "day", "delta", ["segment", "group"])
    return scored.select("segment", "group", "day", r6("depth", 4).alias("depth"), "ml_anomaly")


@query(
    "j4_isolation_forest",
    f"""WITH {LONG} SELECT segment, grp AS "group", count(DISTINCT day) AS n_days, true AS within_quantile
      FROM long WHERE grp IS NOT NULL GROUP BY segment, grp""",
)
def j4_isolation_forest(spark, sf):
    """Seeded forest on all segments: days per group, and whether no more are flagged than the quantile allows."""
    df = with_delta(group_daily(survey(spark, sf), "day", "nps", "mean", SEGMENTS), "day", "metric", ["segment", "group"])
    scored = isolation_score(df, "day", "delta", ["segment", "group"], method="forest")
    allowed = F.floor(0.05 * (F.count("depth") - 1)) + 1
    return scored.groupBy("segment", "group").agg(
        F.count(F.lit(1)).alias("n_days"), (F.count_if("ml_anomaly") <= F.greatest(allowed, F.lit(0))).alias("within_quantile")
    )


@query(
    "j5_contribution",
    f"""WITH {DETECTOR} SELECT segment, grp AS "group", day, {s6("contribution")} AS contribution FROM scored""",
)
def j5_contribution(spark, sf):
    return _scored(spark, sf).select("segment", "group", "day", r6("contribution").alias("contribution"))


@query(
    "j6_rolling_anomaly",
    f"""WITH {DETECTOR} SELECT segment, grp AS "group", day, coalesce(abs(z_score) > 3, false) AS z_anomaly FROM scored""",
)
def j6_rolling_anomaly(spark, sf):
    return _scored(spark, sf).select("segment", "group", "day", rolling_anomaly("z_score", 3.0).alias("z_anomaly"))


_SIGNIFICANT = f"""SELECT b.day, {s6("b.metric")} AS metric, b.total_count, {s6("b.delta_all")} AS delta_all, g.segment,
  w.ml_group, w.z_group, CASE WHEN w.ml_group = w.z_group THEN w.ml_group END AS "group"
FROM base b JOIN (SELECT DISTINCT segment FROM scored) g ON true
LEFT JOIN winners w ON w.day = b.day AND w.segment = g.segment"""


@query("j7_significant_group", f"WITH {DETECTOR}, {WINNERS} {_SIGNIFICANT}")
def j7_significant_group(spark, sf):
    df = segment_anomalies(survey(spark, sf), "day", "nps").significant
    return df.withColumns({"metric": r6("metric"), "delta_all": r6("delta_all")})


@query(
    "j8_segment_anomalies",
    f"""WITH {DETECTOR} SELECT segment, grp AS "group", day, {s6("metric")} AS metric, n_values, {s6("delta")} AS delta,
      {s6("z_score", 4)} AS z_score, {s6("depth", 4)} AS depth, ml_anomaly, {s6("contribution")} AS contribution FROM scored""",
)
def j8_segment_anomalies(spark, sf):
    df = segment_anomalies(survey(spark, sf), "day", "nps").scored
    rounded = {c: r6(c) for c in ("metric", "delta", "contribution")} | {c: r6(c, 4) for c in ("z_score", "depth")}
    return df.withColumns(rounded)


def _reloaded_state(spark, sf):
    """A state started without one month and with a wrong one, then reloaded for both."""
    facts = survey(spark, sf)
    store = Store(spark, scratch(spark, "detector-state"))
    wrong = F.col("day").between(date(1996, 3, 1), date(1996, 3, 31))
    start_detector(store, facts.where((F.trunc("day", "month") != F.lit(date(1995, 7, 1))) & ~(wrong & (F.col("p_brand") > "Brand#3"))), SEGMENTS, "day")
    for start, end in ((date(1995, 7, 1), date(1995, 8, 1)), (date(1996, 3, 1), date(1996, 4, 1))):
        reload_detector(store, facts, start, end, SEGMENTS, "day")
    return stored_anomalies(store, SEGMENTS)


@query("j8_incremental_scores", ORACLES["j8_segment_anomalies"])
def j8_incremental_scores(spark, sf):
    """Scores after the reload of two months, equal to those of all facts at once."""
    rounded = {c: r6(c) for c in ("metric", "delta", "contribution")} | {c: r6(c, 4) for c in ("z_score", "depth")}
    return _reloaded_state(spark, sf).scored.withColumns(rounded)


@query("j8_incremental_significant", ORACLES["j7_significant_group"])
def j8_incremental_significant(spark, sf):
    df = _reloaded_state(spark, sf).significant
    return df.withColumns({"metric": r6("metric"), "delta_all": r6("delta_all")})


_SIZE_LONG = f"""survey AS (SELECT CAST(ts AS DATE) AS day, user_id AS nps, event_type, user_id % 7 AS user_group FROM events),
long AS (SELECT day, nps, 'event_type' AS segment, event_type AS grp FROM survey
  UNION ALL SELECT day, nps, 'user_group', CAST(user_group AS VARCHAR) FROM survey)"""


@query(
    "j8_inquiry_anomalies",
    f"WITH {_SIZE_LONG}, {detector('long', 'count(*)', 'count(*)')}, {WINNERS} {_SIGNIFICANT}",
)
def j8_inquiry_anomalies(spark, sf):
    """The detector on the number of inquiries."""
    df = table(spark, sf, "events").select(
        F.to_date("ts").alias("day"), "user_id", "event_type", F.pmod("user_id", F.lit(7)).alias("user_group")
    )
    out = segment_anomalies(df, "day", "user_id", "size").significant
    return out.withColumns({"metric": r6(F.col("metric").cast("double")), "delta_all": r6(F.col("delta_all").cast("double"))})


@query(
    "j9_inquiry_daily",
    f"""WITH {FLAGS} SELECT i.comp_os_id, i.billing_filial_id, i.itpc_itpc_id, i.sk_subs_id, CAST(i.create_date AS DATE) AS snap_date,
      CAST(date_trunc('week', i.create_date) AS DATE) AS snap_week, CAST(date_trunc('month', i.create_date) AS DATE) AS snap_month,
      CAST(date_trunc('quarter', i.create_date) AS DATE) AS snap_quarter, i.sk_bmt_id, i.subs_os_os_id, i.cr_os_os_id, i.inqr_id,
      {s6("i.value / 10")} AS lat, {s6("i.value / 20")} AS lon, i.description, i.crcat_crcat_id, CAST(1 AS DOUBLE) AS cr_weight,
      t.code_level_1, t.code_level_2, t.code_level_3, t.code_level_4, t.full_name,
      f.flag_indicator AS flag_local_general, CAST(s.filial_id AS BIGINT) AS filial_id, c.subcat_pyramid_name, c.cat_pyramid_name, s.subs_subs_id
    FROM inq i LEFT JOIN topics t ON t.itpc_id = i.itpc_itpc_id AND t.billing_filial_id = i.billing_filial_id
      AND t.start_date <= DATE '2024-01-01' AND t.end_date > DATE '2024-02-01'
    {_SNAP} LEFT JOIN categories c ON c.subcat_pyramid_id = s.subcat_pyramid_id_3m {_ATTACH}
    WHERE {IN_PERIOD.replace("create_date", "i.create_date")}""",
)
def j9_inquiry_daily(spark, sf):
    """All columns of the load."""
    df = inquiry_daily(inquiries(spark, sf), inquiry_dimensions(spark, sf), START, END, AS_OF)
    return df.withColumns({"lat": r6(F.col("lat").cast("double")), "lon": r6(F.col("lon").cast("double")), "cr_weight": F.col("cr_weight").cast("double")})


@query(
    "j10_vas_usage",
    f"""WITH {CHARGES} SELECT d.sk_subs_id, d.snap_date, d.snap_month, {RULE_SQL}
    FROM days d JOIN charges c ON c.sk_subs_id = d.sk_subs_id AND c.start_date = CAST(d.snap_month - INTERVAL 1 MONTH AS DATE)
    WHERE d.snap_date >= DATE '1995-03-01' AND d.snap_date < DATE '2001-01-01' AND c.billing_filial_id = 10
      AND c.start_date >= DATE '1995-02-01' AND c.start_date < DATE '2000-12-01' AND {CHARGE_SQL}
    GROUP BY d.sk_subs_id, d.snap_date, d.snap_month""",
)
def j10_vas_usage(spark, sf):
    df = vas_usage(subscriber_orders(spark, sf), charges(spark, sf), date(1995, 3, 1), date(2001, 1, 1))
    return df.withColumns({n: F.col(n).cast("double") for n in RULES})


# Lines of an order can repeat their number.
_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_SURVEY_GAPS = (
    LINES
    + """, gaps AS (SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS k, l_returnflag, p_brand, p_size + 17 AS age, day, nps,
  CASE WHEN l_quantity <> 13 OR l_returnflag <> 'R' THEN l_quantity END AS l_quantity
  FROM lines JOIN part ON l_partkey = p_partkey)"""
)


@query(
    "j11_prepare_survey",
    f"""WITH {_SURVEY_GAPS}, filled AS (WITH {_knn_sql("gaps", "k", ["l_quantity", "nps"], ", t.l_returnflag, t.p_brand, t.age, t.day")})
    SELECT l_returnflag, p_brand, l_quantity, nps, day AS snap_date_day,
      CASE WHEN age < 25 THEN '18-24' WHEN age < 35 THEN '25-34' WHEN age < 45 THEN '35-44'
        WHEN age < 55 THEN '45-54' WHEN age > 55 THEN '55+' ELSE '55' END AS survey_age_group
    FROM filled""",
)
def j11_prepare_survey(spark, sf):
    """Two numbers with gaps, the metric and a quantity, each filled from the rows near in the other."""
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    raw = lines(spark, sf).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    raw = raw.select(
        *_LINE_KEY,
        F.col("l_shipdate").alias("snap_date"),
        F.col("a").alias("value_1"),
        F.col("b").alias("value_2"),
        (F.col("p_size") + 17).alias("survey_age"),
        F.when((F.col("l_quantity") != 13) | (F.col("l_returnflag") != "R"), F.col("l_quantity")).alias("l_quantity"),
        "l_returnflag",
        "p_brand",
    )
    segments = ["l_returnflag", "p_brand", "l_quantity"]
    df = prepare_survey(raw, _LINE_KEY, segments=segments, ages={"survey_age": "survey_age_group"})
    return df.withColumns({"nps": r6("nps", 4), "l_quantity": r6("l_quantity", 4)})


_INQUIRY_GAPS = """gaps AS (SELECT event_id AS k, CAST(ts AS DATE) AS snap_date_day, event_type AS description, CAST(user_id % 19 AS VARCHAR) AS filial_id,
  CASE WHEN event_type <> 'error' OR user_id % 5 > 0 THEN CAST(user_id % 2 AS DOUBLE) END AS flag_local_general,
  CASE WHEN event_type <> 'view' OR user_id % 7 <> 3 THEN value END AS value FROM events)"""


@query(
    "j11_prepare_inquiry",
    f"""WITH {_INQUIRY_GAPS}, filled AS (WITH {_knn_sql("gaps", "k", ["flag_local_general", "value"], ", t.snap_date_day, t.description, t.filial_id")})
    SELECT snap_date_day, description, filial_id, flag_local_general, value FROM filled""",
)
def j11_prepare_inquiry(spark, sf):
    """Two numbers with gaps, a flag and an amount."""
    raw = table(spark, sf, "events").select(
        F.col("event_id").alias("inqr_id"),
        F.col("ts").alias("snap_date"),
        F.col("event_type").alias("description"),
        F.pmod("user_id", F.lit(19)).alias("filial_id"),
        F.when((F.col("event_type") != "error") | (F.pmod("user_id", F.lit(5)) > 0), F.pmod("user_id", F.lit(2))).alias("flag_local_general"),
        F.when((F.col("event_type") != "view") | (F.pmod("user_id", F.lit(7)) != 3), F.col("value")).alias("value"),
    )
    df = prepare_inquiry(raw, ["inqr_id"], segments=["description", "filial_id", "flag_local_general", "value"])
    return df.withColumns({"flag_local_general": r6("flag_local_general", 4), "value": r6("value", 4)})


_ROLES = ProfileColumns("day", "nps", "p_brand", "survey_age", "p_type")
_REPORT_KEYS = {
    "missing": ("column", "column", "missing_percent"),
    "categories": ("column", "value", "n"),
    "histogram": ("column", "bin", "n"),
    "curve": ("column", "step", "density"),
    **{f"region_box:{c}": ("p_brand", "n", c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")},
    **{f"age_box:{c}": ("age_group", "n", c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")},
    "revenue_density": ("p_type", "bin", "density"),
    "regions": ("value", "value", "n"),
    "daily": ("day", "n_rows", "metric"),
    "daily_by_group": ("group", "day", "metric"),
}
_PROFILED = (
    LINES
    + """, profiled AS (SELECT l.day, l.nps, l.l_quantity, l.l_returnflag, p.p_brand, p.p_type, p.p_size + 17 AS survey_age
  FROM lines l JOIN part p ON l.l_partkey = p.p_partkey),
aged AS (SELECT *, CASE WHEN survey_age >= 55 THEN '55+' WHEN survey_age >= 45 THEN '45-54' WHEN survey_age >= 35 THEN '35-44'
  WHEN survey_age >= 25 THEN '25-34' WHEN survey_age >= 18 THEN '18-24' END AS age_group FROM profiled),
best AS (SELECT * FROM profiled WHERE p_brand IN (SELECT p_brand FROM profiled GROUP BY p_brand ORDER BY avg(nps) DESC, p_brand LIMIT 10))"""
)


def _part(topic, item, part, value):
    return f"""SELECT '{topic}' AS topic, CAST({item} AS VARCHAR) AS item, CAST({part} AS VARCHAR) AS part, CAST({value} AS DOUBLE) AS value"""


_REPORT_SQL = " UNION ALL ".join(
    [
        _part("missing", "'nps'", "'nps'", "100.0 * (count(*) - count(nps)) / count(*)") + " FROM profiled HAVING count(*) > count(nps)",
        *[
            f"{_part('categories', repr(c), c, 'n')} FROM (SELECT {c}, count(*) AS n FROM profiled GROUP BY {c} ORDER BY n DESC, {c} LIMIT 15)"
            for c in ("l_returnflag", "p_brand", "p_type")
        ],
        _part("histogram", '"column"', "bin", "n") + f" FROM (WITH {_histogram_sql('profiled', ['l_quantity'])})",
        _part("curve", '"column"', "step", "density") + f" FROM (WITH {_curve_sql('profiled', ['l_quantity'])})",
        *[_part(f"region_box:{c}", "p_brand", "n", c) + f" FROM (WITH {_box_sql('best', 'p_brand', 'nps')})" for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        *[_part(f"age_box:{c}", "age_group", "n", c) + f" FROM (WITH {_box_sql('aged', 'age_group', 'nps')})" for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
        _part("revenue_density", "p_type", "bin", "count(*) / (total * width)")
        + """ FROM (SELECT v.p_type, CAST(least(floor((nps - lo) / width), 29) AS INTEGER) AS bin, width, total FROM profiled v JOIN (
          SELECT p_type, min(nps) AS lo, (max(nps) - min(nps)) / 30 AS width, count(nps) AS total FROM profiled GROUP BY p_type) r
          ON v.p_type = r.p_type WHERE nps IS NOT NULL) GROUP BY p_type, bin, total, width""",
        _part("regions", "p_brand", "p_brand", "count(*)") + " FROM profiled GROUP BY p_brand",
        _part("daily", "day", "count(*)", "avg(nps)") + " FROM profiled GROUP BY day",
        *[
            _part("daily_by_group", c, "day", "avg(nps)") + f" FROM profiled WHERE {c} IS NOT NULL GROUP BY {c}, day"
            for c in ("l_returnflag", "p_brand", "p_type", "l_quantity")
        ],
    ]
)


@query("j12_profile", f"WITH {_PROFILED}, report AS ({_REPORT_SQL}) SELECT topic, item, part, {s6('value')} AS value FROM report")
def j12_profile(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand", "p_type", (F.col("p_size") + 17).alias("survey_age"))
    df = lines(spark, sf).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    df = df.select("day", "nps", "l_quantity", "l_returnflag", "p_brand", "p_type", "survey_age")
    report = profile(df, ["l_returnflag", "p_brand", "p_type", "l_quantity", "network_volte"], _ROLES)
    return report_rows(report, _REPORT_KEYS).withColumn("value", r6("value"))


_INQUIRY_PROFILED = """facts AS (SELECT CAST(ts AS DATE) AS day, event_type AS description, CAST(user_id % 19 AS VARCHAR) AS filial_id,
  CASE WHEN event_type <> 'error' THEN CAST(user_id % 7 AS VARCHAR) END AS category FROM events)"""
_INQUIRY_GROUPS = ("description", "filial_id", "category")
_INQUIRY_REPORT = " UNION ALL ".join(
    [
        _part("missing", "'category'", "'category'", "100.0 * (count(*) - count(category)) / count(*)") + " FROM facts HAVING count(*) > count(category)",
        *[
            f"{_part('categories', repr(c), c, 'n')} FROM (SELECT {c}, count(*) AS n FROM facts WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 15)"
            for c in _INQUIRY_GROUPS
        ],
        _part("regions", "filial_id", "filial_id", "count(*)") + " FROM facts GROUP BY filial_id",
        _part("daily", "day", "count(*)", "count(*)") + " FROM facts GROUP BY day",
        *[_part("daily_by_group", c, "day", "count(*)") + f" FROM facts WHERE {c} IS NOT NULL GROUP BY {c}, day" for c in _INQUIRY_GROUPS],
    ]
)


@query(
    "j12_inquiry_profile",
    f"WITH {_INQUIRY_PROFILED}, report AS ({_INQUIRY_REPORT}) SELECT topic, item, part, {s6('value')} AS value FROM report",
)
def j12_inquiry_profile(spark, sf):
    """The report of a table without score and age: numbers of rows a day, in all and for each group."""
    df = table(spark, sf, "events").select(
        F.to_date("ts").alias("day"),
        F.col("event_type").alias("description"),
        F.pmod("user_id", F.lit(19)).cast("string").alias("filial_id"),
        F.when(F.col("event_type") != "error", F.pmod("user_id", F.lit(7)).cast("string")).alias("category"),
    )
    report = profile(df, [*_INQUIRY_GROUPS, "network_volte"], replace(INQUIRY_COLUMNS, day="day"))
    keys = {t: _REPORT_KEYS[t] for t in ("missing", "categories", "regions", "daily")} | {"daily_by_group": ("group", "day", "metric")}
    return report_rows(report, keys).withColumn("value", r6("value"))


@query(
    "j13_series_correlation",
    f"WITH {PAIRS} SELECT count(*) AS n, {s6('corr(x, y)')} AS pearson, {s6('corr(rx, ry)')} AS spearman FROM ranked",
)
def j13_series_correlation(spark, sf):
    orders = table(spark, sf, "orders").withColumn("day", F.to_date("o_orderdate"))
    df = series_correlation(lines(spark, sf), orders, "day", "nps", "o_orderkey")
    return df.select("n", r6("pearson").alias("pearson"), r6("spearman").alias("spearman"))
