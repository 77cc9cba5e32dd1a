"""The whole chains on small tables with the full column lists."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.plans.detector import detect_to_tables, segment_anomalies
from tidemark.plans.inquiry import InquiryDimensions, inquiry_daily
from tidemark.plans.survey import INQUIRY_SEGMENTS, SURVEY_SEGMENTS, prepare_inquiry, prepare_survey
from tidemark.plans.vas import vas_usage
from tidemark.sources.sinks import create_table, reload_table, write_processed
from tidemark.sources.tables import read_table

START, END = date(2025, 1, 1), date(2025, 3, 1)


def raw_survey(spark, n=400):
    rng = random.Random(2)
    names = [s for s in SURVEY_SEGMENTS if s != "filial_id"]
    schema = schemas.survey_raw(SURVEY_SEGMENTS)
    rows = [
        {s: rng.choice(["a_1", "b", "nan", None]) for s in names}
        | {
            "sk_subs_id": i,
            "snap_date": datetime(2025, 1, 1) + timedelta(hours=rng.randrange(24 * 30)),
            "filial_id": rng.randint(1, 3),
            "survey_age": rng.randint(18, 70),
            "survey_operator_age": rng.randint(18, 70),
            "value_1": rng.random() - 0.5,
            "value_2": rng.choice([0.0, 1.0, 2.0]),
        }
        for i in range(n)
    ]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


def test_survey_chain(spark, tmp_path):
    path = str(tmp_path / "raw.csv")
    raw_survey(spark).write.option("header", True).csv(path)
    processed = prepare_survey(read_table(spark, path, schemas.survey_raw(SURVEY_SEGMENTS)))
    assert {r[0] for r in processed.select("network_volte").distinct().collect()} == {"a_1", "b", None}
    assert len(processed.columns) == 29 and processed.where("nps IS NULL").count() == 0
    write_processed(processed, str(tmp_path / "survey"))
    stored = spark.read.parquet(str(tmp_path / "survey"))
    detect_to_tables(stored, str(tmp_path / "out"), wide=True)
    significant = spark.read.parquet(str(tmp_path / "out" / "significant"))
    assert significant.select("segment").distinct().count() == 27
    assert significant.count() == 27 * stored.select("snap_date_day").distinct().count()
    groups = stored.select([F.count_distinct(c).alias(c) for c in stored.columns if c not in ("snap_date_day", "nps")]).head()
    blocks = [spark.read.option("header", True).csv(str(p)) for p in sorted((tmp_path / "out" / "contributions_wide").iterdir())]
    assert sum(len(b.columns) - 1 for b in blocks) == sum(groups)
    contributions = spark.read.parquet(str(tmp_path / "out" / "contributions"))
    assert contributions.where("abs(contribution) > 1").count() == 0


def test_inquiry_chain(spark):
    rng = random.Random(3)
    rows = [
        (i, datetime(2025, 1, 1) + timedelta(hours=rng.randrange(24 * 20)), rng.randint(1, 4), rng.choice("xyz"), rng.choice("pq"), rng.choice("mn"), "c", rng.choice([0, 1, None]))
        for i in range(300)
    ]
    raw = spark.createDataFrame(
        rows,
        "sk_subs_id long, snap_date timestamp, filial_id long, description string, subcat_pyramid_name string, full_name string, cat_pyramid_name string, flag_local_general int",
    )
    processed = prepare_inquiry(raw)
    assert sorted(processed.columns) == sorted([*INQUIRY_SEGMENTS, "snap_date_day"])
    result = segment_anomalies(processed, metric="filial_id", func="size")
    assert result.significant.select("segment").distinct().count() == 5
    assert result.base.agg(F.sum("metric")).head()[0] == 300


def test_fact_loads_and_reloads(spark, tmp_path):
    def moment(day, month=1):
        return datetime(2025, month, day, 10)

    def inquiry(i, subs, ts, cell=1, site=5, category=1, company=150):
        return (ts, company, 7, 70, subs, cell, 0, site, i, None, None, "text", category, Decimal("1.00"))

    facts = [inquiry(i, 1, moment(1)) for i in range(12)] + [inquiry(20 + d, 2, moment(d)) for d in range(2, 8)]
    facts += [inquiry(40, 1, moment(3, 2), cell=2, site=6), inquiry(50, 1, moment(1, 3))]
    far = datetime(2999, 1, 1)
    dims = InquiryDimensions(
        spark.createDataFrame([(70, 7, date(2020, 1, 1), date(2999, 1, 1), "1", "2", "3", "4", "topic"), (70, 7, date(2025, 2, 1), date(2999, 1, 1), "-", "-", "-", "-", "later")], schemas.TOPIC_HISTORY),
        spark.createDataFrame([(1, date(2025, 1, 1), 9, 900, 3), (1, date(2024, 12, 31), 8, 800, 3)], schemas.SUBSCRIBER_SNAPSHOT),
        spark.createDataFrame([(3, "sub", "cat")], schemas.PYRAMID_CATEGORY),
        spark.createDataFrame([(1, 5, far), (1, 6, datetime(2020, 1, 1))], schemas.CELLS),
        spark.createDataFrame([(5, "r", far)], schemas.ORGANISATIONS),
    )
    fresh = inquiry_daily(spark.createDataFrame(facts, schemas.INQUIRY_SOURCE), dims, START, END)
    create_table(spark, "inquiry_case", schemas.INQUIRY_DAILY, path=str(tmp_path / "i"))
    for _ in range(2):
        reload_table(spark, "inquiry_case", fresh, START, END)
    loaded = spark.table("inquiry_case")
    assert loaded.count() == 19 and loaded.select("full_name").distinct().collect()[0][0] == "topic"
    flags = {(r["snap_date"], r["flag_local_general"]) for r in loaded.where("cr_os_os_id = 5").collect()}
    assert flags == {(date(2025, 1, 1), 1)} | {(date(2025, 1, d), 0) for d in range(2, 8)}
    other = loaded.where("inqr_id = 40").head()
    assert other["flag_local_general"] is None and other["cat_pyramid_name"] is None and other["snap_week"] == date(2025, 2, 3)
    assert {r["cat_pyramid_name"] for r in loaded.where("snap_date = DATE '2025-01-01'").collect()} == {"cat"}

    charges = spark.createDataFrame([(1, 10, date(2024, 12, 1), 30, 16, None, Decimal(5), Decimal(0)), (1, 10, date(2025, 1, 1), None, None, 10600050, Decimal(0), Decimal(7))], schemas.CHARGES)
    create_table(spark, "vas_case", schemas.VAS_USAGE, path=str(tmp_path / "v"))
    reload_table(spark, "vas_case", vas_usage(loaded, charges, START, END), START, END)
    got = {(r["snap_date"], float(r["product_perepl_mn"]), float(r["product_kz"])) for r in spark.table("vas_case").collect()}
    assert got == {(date(2025, 1, 1), 5.0, 0.0), (date(2025, 2, 3), 0.0, 7.0)}
    for t in ("inquiry_case", "vas_case"):
        spark.sql(f"DROP TABLE {t}")


def test_options_for_missing_categories(spark):
    raw = raw_survey(spark, 120).replace("nan", None)
    segments = ["survey_gender", "network_volte", "network_vowifi"]
    raw = raw.select("sk_subs_id", "snap_date", "survey_age", "value_1", "value_2", *segments)
    ages = {"survey_age": "survey_age_group"}
    kept = prepare_survey(raw, segments=segments, ages=ages)
    assert kept.where("network_volte IS NULL").count() > 0
    filled = prepare_survey(
        raw, segments=segments, ages=ages, mode=["survey_gender"], predict=["network_volte"], placeholder="missing"
    )
    assert filled.columns == kept.columns and filled.count() == 120
    assert filled.where(" OR ".join(f"{c} IS NULL" for c in filled.columns)).count() == 0
    values = {c: {r[0] for r in filled.select(c).distinct().collect()} for c in segments}
    assert values["survey_gender"] <= {"a_1", "b"} and values["network_volte"] <= {"a_1", "b"}
    assert "missing" in values["network_vowifi"]
