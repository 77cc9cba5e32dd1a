"""One small table per agreed rule."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import calendar as cal
from tidemark.functions import scalars as sc
from tidemark.operators.columns import select_required
from tidemark.operators.correlation import correlations, two_sided_p, with_p_values
from tidemark.operators.isolation import isolation_score
from tidemark.operators.profile import box_statistics, density_histogram, histogram
from tidemark.operators.ranking import category_codes
from tidemark.operators.segments import (
    group_daily,
    keep_large_groups,
    significant_groups,
    to_wide,
    wide_names,
    with_contribution,
)
from tidemark.operators.series import daily_metric, with_delta, with_rolling_score
from tidemark.operators.site_flags import cell_counts, with_flag, with_week_statistics
from tidemark.plans.detector import segment_anomalies
from tidemark.plans.vas import RULES, vas_usage
from tidemark.sources.sinks import create_table, reload_period, reload_table
from tidemark.sources.tables import read_table


def column(df, c):
    return [r[c] for r in df.collect()]


def d(day, month=1, year=2024):
    return date(year, month, day)


def test_ratio_edges(spark):
    rows = [(1.0, 0.0, 1.0), (-1.0, 0.0, -1.0), (0.0, 0.0, None), (0.05, 0.5, 0.1), (3.0, 1.0, 1.0), (None, 1.0, None), (1.0, None, None)]
    df = spark.createDataFrame(rows, "a double, b double, want double")
    got = df.withColumn("r", sc.clipped_ratio("a", "b")).collect()
    assert all(r["want"] == r["r"] or abs(r["want"] - r["r"]) < 1e-12 for r in got)


@pytest.mark.parametrize(
    "age, strict, binned",
    [
        (17, "17", None), (18, "18-24", "18-24"), (24, "18-24", "18-24"), (25, "25-34", "25-34"), (34, "25-34", "25-34"),
        (35, "35-44", "35-44"), (44, "35-44", "35-44"), (45, "45-54", "45-54"), (54, "45-54", "45-54"), (55, "55", "55+"),
        (56, "55+", "55+"), (None, None, None),
    ],
)
def test_age_edges(spark, age, strict, binned):
    row = spark.createDataFrame([(age,)], "a int").select(sc.age_band("a").alias("s"), sc.age_bin("a").alias("b")).head()
    assert (row["s"], row["b"]) == (strict, binned)


def test_hour_edges(spark):
    hours = {"05:59": 3, "06:00": 0, "11:59": 0, "12:00": 1, "17:59": 1, "18:00": 2, "21:59": 2, "22:00": 3, "00:00": 3}
    df = spark.createDataFrame([(f"2024-01-01 {h}:00", cal.TIME_GROUPS[g]) for h, g in hours.items()], "t string, want string")
    got = df.select("want", cal.time_group(F.col("t").cast("timestamp")).alias("g")).collect()
    assert all(r["want"] == r["g"] for r in got)


def test_calendar_edges(spark):
    days = {
        d(30, 12): (1, 5, "Понедельник"), date(2023, 1, 1): (52, 1, "Воскресенье"), d(29, 2): (9, 5, "Четверг"),
        d(7): (1, 1, "Воскресенье"), d(8): (2, 2, "Понедельник"), d(28): (4, 4, "Воскресенье"), d(31): (5, 5, "Среда"),
    }
    df = spark.createDataFrame([(k, *v) for k, v in days.items()], "t date, iso int, week int, name string")
    got = df.select("iso", "week", "name", F.weekofyear("t").alias("i"), cal.week_of_month("t").alias("w"), cal.weekday_name("t").alias("n"))
    assert all((r["iso"], r["week"], r["name"]) == (r["i"], r["w"], r["n"]) for r in got.collect())
    assert cal.shift_month_start(d(31), -1) == date(2023, 12, 1)
    assert cal.shift_month_start(d(15, 12), 1) == date(2025, 1, 1)


def test_gap_series(spark):
    rows = [(d(1), 1.0), (d(2), 3.0), (d(5), None), (d(6), 4.0), (d(7), 9.0)]
    daily = daily_metric(spark.createDataFrame(rows, "day date, v double"), "day", "v")
    got = with_delta(daily, "day", "metric").orderBy("day").collect()
    # The day without a metric and the one after it have no change of their own and take the next one.
    assert [r["delta"] for r in got] == [2.0, 2.0, 5.0, 5.0, 5.0]
    one = with_delta(daily.limit(1), "day", "metric")
    assert column(one, "delta") == [None]


def test_rolling_score_first_row_and_center(spark):
    df = spark.createDataFrame([(d(i), float(v), float(v)) for i, v in enumerate([1, 2, 4, 8], 1)], "day date, metric double, delta double")
    z = column(with_rolling_score(df, "day", "metric").orderBy("day"), "z_score")
    assert z[0] is None and z[1] == pytest.approx((2 - 1.5) / (0.5**0.5 + 1e-6))
    shifted = df.withColumn("delta", F.col("delta") + 10)
    by_metric = column(with_rolling_score(shifted, "day", "metric").orderBy("day"), "z_score")
    by_delta = column(with_rolling_score(shifted, "day", "metric", center="delta").orderBy("day"), "z_score")
    assert by_metric[1] != pytest.approx(by_delta[1])


def _flags(spark, counts, center="mean"):
    rows = [(1, 1, 2024, 1, 1, i, c) for i, c in enumerate(counts, 1)]
    df = spark.createDataFrame(rows, "os_os_id long, sk_bmt_id long, year int, month int, week int, day int, c long")
    return with_flag(with_week_statistics(df, center)).orderBy("day")


@pytest.mark.parametrize(
    "counts, flags",
    [
        ([1, 2, 3, 1, 1, 1, 3], [0] * 7),  # range below 3 wins over everything
        ([1, 11, 1, 1, 1, 1, 1], [0, 1, 0, 0, 0, 0, 0]),  # 10 above the minimum
        ([5, 5, 5, 5], [0] * 4),  # no deviation
        ([7], [0]),
        ([5, 5, 5, 5, 5, 5, 9], [0, 0, 0, 0, 0, 0, 1]),  # z above 3 around a mean near the rest
        ([3, 3, 5, 6, 8, 8, 9], [0] * 7),  # range 6, largest z 1.01
        ([5, 4, 6, 5, 4, 6, 9], [0, 0, 0, 0, 0, 0, 1]),  # z 4.72 on the last day
    ],
)
def test_flag_rule(spark, counts, flags):
    assert column(_flags(spark, counts), "flag_indicator") == flags


def test_zero_deviation_gives_no_z(spark):
    assert column(_flags(spark, [5, 5, 5, 9], "median"), "z_modif") == [None] * 4


def test_fanout_multiplies_counts(spark):
    facts = spark.createDataFrame([(1, datetime(2024, 1, 1, 5)), (1, datetime(2024, 1, 1, 6)), (2, datetime(2024, 1, 2)), (None, datetime(2024, 1, 2))], "sk_bmt_id long, create_date timestamp")
    cells = spark.createDataFrame([(1, 10), (2, 20), (2, 21)], "sk_bmt_id long, os_os_id long")
    org = spark.createDataFrame([(10, "a"), (10, "b"), (10, "b"), (20, None)], "os_os_id long, ro string")
    got = {(r["os_os_id"], r["sk_bmt_id"]): r["c"] for r in cell_counts(facts, cells, org).collect()}
    assert got == {(10, 1): 4, (20, 2): 1, (21, 2): 1, (None, None): 1}
    once = {(r["os_os_id"], r["sk_bmt_id"]): r["c"] for r in cell_counts(facts, cells, org, dedupe=True).collect()}
    assert once[(10, 1)] == 2


def test_winner_ties(spark):
    rows = [
        (d(1), "s", "b_2", True, 5.0, 0.4), (d(1), "s", "a_1", True, 5.0, -0.4), (d(1), "s", "c", True, 5.0, 0.1),
        (d(2), "s", "a_1", False, 1.0, 0.9), (d(2), "s", "c", True, 1.0, 0.2),
        (d(3), "s", "c", False, None, None),
    ]
    df = spark.createDataFrame(rows, "day date, segment string, group string, ml_anomaly boolean, z_score double, contribution double")
    got = [(r["ml_group"], r["z_group"], r["group"]) for r in significant_groups(df).orderBy("day").collect()]
    assert got == [("a_1", "a_1", "a_1"), ("c", None, None), (None, None, None)]


def test_first_winner(spark):
    rows = [(d(1), "s", "z", False, 0.0, 0.0), (d(2), "s", "a", True, 5.0, 0.9), (d(2), "s", "z", True, 5.0, 0.1)]
    df = spark.createDataFrame(rows, "day date, segment string, group string, ml_anomaly boolean, z_score double, contribution double")
    assert significant_groups(df, by="first").orderBy("day").collect()[1]["group"] == "z"
    assert significant_groups(df).orderBy("day").collect()[1]["group"] == "a"


def test_flat_total_and_clipping(spark):
    rows = [(1.0, 1, 0.0, 2), (1.0, 1, 1e-9, 2), (1.0, 1, 1e-7, 2), (1.0, 1, 4.0, 2), (1.0, 1, None, 2)]
    df = spark.createDataFrame(rows, "delta double, n_values long, delta_all double, total_count long")
    assert column(with_contribution(df), "contribution") == [0.0, 0.0, 1.0, 0.125, None]
    assert column(with_contribution(df, clipped=False), "contribution")[2] == pytest.approx(0.5e7)


def test_small_and_null_groups(spark):
    rows = [(d(1), 1.0, "one")] + [(d(i), 1.0, "two") for i in (1, 2)] + [(d(i), 1.0, None) for i in (1, 2, 3)]
    df = spark.createDataFrame(rows, "day date, v double, seg string")
    daily = group_daily(df, "day", "v", "mean", ["seg"])
    assert {r["group"] for r in keep_large_groups(daily, 2).collect()} == {"two"}
    result = segment_anomalies(df, "day", "v", min_group_size=5)
    assert result.significant.count() == 0


def test_days_without_the_group_stay_in_the_result(spark):
    rows = [(d(i), float(i % 3), "x" if i != 4 else None) for i in range(1, 8)]
    out = segment_anomalies(spark.createDataFrame(rows, "day date, v double, seg string"), "day", "v").significant
    assert out.count() == 7


def test_isolation_outlier_and_constant(spark):
    rows = [("far", d(1), 100.0)] + [("far", date(2024, 2, 1 + i % 28), float(i)) for i in range(28)]
    rows += [("flat", d(i), 1.0) for i in range(1, 20)] + [("null", d(1), None), ("two", d(1), 1.0), ("two", d(2), 2.0)]
    df = spark.createDataFrame(rows, "k string, day date, delta double")
    for method in ("exact", "forest"):
        scored = isolation_score(df, "day", "delta", ["k"], method=method)
        flagged = {(r["k"], r["delta"]) for r in scored.where("ml_anomaly").collect()}
        assert ("far", 100.0) in flagged and not any(k in ("flat", "null", "two") for k, _ in flagged)
        assert scored.count() == len(rows)


def test_reload(spark):
    old = spark.createDataFrame([(d(31, 12, 2023), 1), (d(1), 2), (d(15), 3), (d(1, 2), 4), (None, 5)], "snap_date date, n int")
    fresh = spark.createDataFrame([(d(2), 9)], "snap_date date, n int")
    once = reload_period(old, fresh, d(1), d(1, 2))
    assert sorted(column(once, "n")) == [1, 4, 5, 9]
    assert sorted(column(reload_period(once, fresh, d(1), d(1, 2)), "n")) == [1, 4, 5, 9]


def test_reload_table_in_place(spark, tmp_path):
    create_table(spark, "reload_case", spark.createDataFrame([], "n int, snap_date date").schema, path=str(tmp_path / "t"))
    old = spark.createDataFrame([(1, d(31, 12, 2023)), (2, d(1)), (3, d(15)), (4, d(1, 2))], "n int, snap_date date")
    reload_table(spark, "reload_case", old, d(1, 12, 2023), d(1, 3))
    fresh = spark.createDataFrame([(9, d(2))], "n int, snap_date date")
    for _ in range(2):
        reload_table(spark, "reload_case", fresh, d(1), d(1, 2))
        assert sorted(column(spark.table("reload_case"), "n")) == [1, 4, 9]
    with pytest.raises(Exception, match="outside"):
        reload_table(spark, "reload_case", fresh, d(1, 3), d(1, 4))
    assert sorted(column(spark.table("reload_case"), "n")) == [1, 4, 9]
    spark.sql("DROP TABLE reload_case")


def test_vas_rules(spark):
    def charge(subs=1, branch=10, month=d(1, 12, 2023), detg=None, lcal=None, vas=None, amount=1, revenue=100):
        return (subs, branch, month, detg, lcal, vas, None if amount is None else Decimal(amount), Decimal(revenue))

    rows = [
        charge(detg=30, lcal=16), charge(detg=30, lcal=7, amount=2), charge(detg=21, lcal=468, amount=4), charge(detg=25, lcal=23, amount=8),
        charge(vas=10600078), charge(vas=10600050), charge(vas=10600045), charge(vas=10600095),
        charge(detg=30, lcal=1, amount=64), charge(detg=30, lcal=16, amount=None), charge(detg=7, lcal=16, amount=64),
        charge(branch=11, detg=30, lcal=16, amount=64), charge(month=d(1), detg=30, lcal=16, amount=64), charge(subs=2, detg=30, lcal=16),
    ]
    charges = spark.createDataFrame(rows, schemas.CHARGES)
    days = [(1, d(5), d(1)), (1, d(5), d(1)), (1, d(6), d(1)), (3, d(6), d(1)), (1, d(5, 2), d(1, 2))]
    inquiries = spark.createDataFrame(days, "sk_subs_id long, snap_date date, snap_month date")
    got = vas_usage(inquiries, charges, d(1), d(1, 2)).orderBy("snap_date").collect()
    assert [(r["sk_subs_id"], r["snap_date"]) for r in got] == [(1, d(5)), (1, d(6))]
    assert [float(got[0][m]) for m in RULES] == [1, 2, 4, 8, 100, 100, 100, 100]
    two = vas_usage(inquiries, charges, d(1), d(1, 3)).where(F.col("snap_month") == d(1, 2)).head()
    assert float(two["product_perepl_mn"]) == 64


def test_constant_series(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "x double, y double")
    row = with_p_values(correlations(df, "x", "y")).head()
    assert row["n"] == 5 and row["pearson"] is None and row["spearman_p"] is None


def test_perfect_and_known_p_values(spark):
    df = spark.createDataFrame([(float(i), float(2 * i)) for i in range(5)], "x double, y double")
    assert with_p_values(correlations(df, "x", "y")).head()["spearman_p"] < 1e-12
    # Table values of Student's t.
    assert two_sided_p(2.228138852, 10) == pytest.approx(0.05, abs=1e-8)
    assert two_sided_p(12.706204736, 1) == pytest.approx(0.05, abs=1e-8)
    assert two_sided_p(1.959963985, 1e7) == pytest.approx(0.05, abs=1e-6)
    assert two_sided_p(0.0, 4) == 1.0


def test_histogram_edges_and_totals(spark):
    df = spark.createDataFrame([(float(i), "g" if i % 2 else None) for i in range(31)], "v double, g string")
    h = histogram(df, ["v"]).orderBy("bin").collect()
    assert sum(r["n"] for r in h) == 31 and h[-1]["n"] == 2 and h[-1]["bin"] == 29
    assert histogram(df, ["v"], min_distinct=31).count() == 0
    dens = density_histogram(df, "g", "v").collect()
    width = (29.0 - 1.0) / 30
    assert sum(r["density"] * width for r in dens) == pytest.approx(1.0)
    flat = density_histogram(spark.createDataFrame([("g", 2.0)] * 3, "g string, v double"), "g", "v").collect()
    assert [(r["bin"], r["n"], r["density"]) for r in flat] == [(15, 3, 30.0)]


def test_histogram_counts_few_values_exactly(spark):
    df = spark.createDataFrame([(float(i % 16), float(i % 15)) for i in range(400)], "a double, b double")
    assert {r["column"] for r in histogram(df, ["a", "b"]).collect()} == {"a"}


def test_box_hides_outliers(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, v double")
    row = box_statistics(df, "g", "v").head()
    assert (row["q1"], row["median"], row["q3"], row["whisker_low"], row["whisker_high"]) == (2.25, 3.5, 4.75, 1.0, 5.0)


def test_wide_export_in_blocks(spark):
    df = spark.createDataFrame([(d(1), "s", "a", 1.0), (d(2), "s", "b", 2.0)], "day date, segment string, group string, z double")
    (segment, names), = wide_names(df, "z")
    assert segment == "s" and [n for _, n in wide_names(df, "z", 1)] == [["z_s_a"], ["z_s_b"]]
    many = spark.range(5100).selectExpr("concat('s', id % 2) AS segment", "cast(id AS string) AS group", "1.0 AS z")
    assert [len(n) for _, n in wide_names(many, "z", 2000)] == [2000, 550, 2000, 550]
    wide = to_wide(df, "day", "z", names).orderBy("day")
    assert wide.columns == ["day", "z_s_a", "z_s_b"]
    assert [tuple(r)[1:] for r in wide.collect()] == [(1.0, None), (None, 2.0)]


def test_codes_round_trip(spark):
    values = [f"v{i * 7919 % 3000:04d}" for i in range(3000)] + [None]
    df = spark.createDataFrame([(v,) for v in values * 2], "c string")
    codes = {r["value"]: r["code"] for r in category_codes(df, "c").collect()}
    assert codes == {v: i for i, v in enumerate(sorted({v for v in values if v}))}


def test_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="absent"):
        select_required(spark.range(1), ["id", "absent"])


def test_csv_missing_texts(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\nx,1.5\nnan,nan\n,\n")
    df = read_table(spark, str(tmp_path / "t.csv"), spark.createDataFrame([], "a string, b double").schema)
    assert [tuple(r) for r in df.collect()] == [("x", 1.5), (None, None), (None, None)]


def test_contributions_sum_to_one_for_steady_groups(spark):
    rows = [(d(i), float((i * k * 37) % 11), f"g{k}") for i in range(1, 15) for k in (1, 2, 3) for _ in range(2)]
    df = spark.createDataFrame(rows, "day date, v double, seg string")
    result = segment_anomalies(df, "day", "v", clip_contributions=False)
    base = {r["day"]: r["delta_all"] for r in result.base.collect()}
    sums = result.contributions.groupBy("day").agg(F.sum("contribution").alias("s")).collect()
    assert all(r["s"] == pytest.approx(1.0) for r in sums if abs(base[r["day"]]) > 1e-8)


def test_schemas_name_the_result_tables():
    assert len(schemas.INQUIRY_DAILY) == 27 and not schemas.INQUIRY_DAILY["snap_date"].nullable
    assert tuple(RULES) == schemas.VAS_MEASURES
