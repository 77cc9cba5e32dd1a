"""NaN, infinity and texts for missing values."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions.scalars import clip, clipped_ratio, text_null
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.segments import rolling_anomaly
from tidemark.plans.detector import score_groups

NAN, INF = float("nan"), float("inf")


def test_ratio_of_nan_and_infinity(spark):
    rows = [(NAN, 1.0), (1.0, NAN), (NAN, 0.0), (NAN, NAN), (INF, INF), (INF, 1.0), (-INF, 1.0), (1.0, INF), (INF, 0.0), (None, NAN)]
    got = [r["x"] for r in spark.createDataFrame(rows, "a double, b double").select(clipped_ratio("a", "b").alias("x")).collect()]
    assert got == [None, None, None, None, None, 1.0, -1.0, 0.0, 1.0, None]


def test_clip_and_flag_of_nan(spark):
    df = spark.createDataFrame([(NAN,), (INF,), (None,), (4.0,), (-4.0,), (2.0,)], "x double")
    got = [tuple(r) for r in df.select(clip(F.col("x"), -3.0, 3.0), rolling_anomaly("x", 3.0)).collect()]
    assert got == [(None, False), (3.0, True), (None, False), (3.0, True), (-3.0, True), (2.0, False)]


def test_nan_metric_is_a_gap_for_the_detector(spark):
    rng = random.Random(1)
    rows = [(d, rng.gauss(0, 1), "ab"[d % 2 if i else 0]) for d in range(1, 20) for i in range(4)]
    rows.append((3, NAN, "a"))
    typed = spark.createDataFrame(rows, "d int, v double, s string").withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    scored = score_groups(typed, "d", "v", segments=["s"]).collect()
    assert scored and not any(r["metric"] is not None and math.isnan(r["metric"]) for r in scored)


def test_texts_for_missing_values(spark):
    df = spark.createDataFrame([("nan",), ("",), ("NA",), ("None",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(text_null("t")).collect()] == [None, None, None, None, "x", None]
    assert [r[0] for r in df.select(text_null("t", ["x"])).collect()] == ["nan", "", "NA", "None", None, None]


def test_quantiles_of_a_long_tail(spark):
    """Values over many orders of magnitude: ranges shrink until they are small, and stay exact."""
    rng = random.Random(7)
    values = [math.exp(rng.gauss(0, 4)) for _ in range(20_000)]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    got = exact_quantiles(df, ["g"], "v", [0.25, 0.5, 0.99], ["a", "b", "c"], bins=64, limit=200).first()
    want = df.agg(F.percentile("v", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.99)))).first()[0]
    assert [got["a"], got["b"], got["c"]] == pytest.approx(want)


def test_facts_without_a_key_are_spread(spark):
    """Most facts have no key: they stay, unmatched, and no partition of the exchange holds them all."""
    from tidemark.operators.joins import join_lookup

    facts = spark.range(4000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN id % 7 END AS k")
    dim = spark.range(5).selectExpr("id AS dk", "concat('n', id) AS name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_lookup(facts, dim, "k", "dk", ["name"])
        got = {r["id"]: r["name"] for r in joined.collect()}
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert got == {i: f"n{i % 7}" if i % 10 == 0 and i % 7 < 5 else None for i in range(4000)}
    assert max(sizes) < 1500
