"""Versioned tables and the incremental detector: what readers see, what is read, what fails."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans.detector import segment_anomalies
from tidemark.plans.incremental import FROM_SUMS, SCORED, SUMS, daily_of_sums, merged_sums, partial_sums, reload_detector, start_detector, stored_anomalies
from tidemark.sources.versions import Store, reload_version

SEGMENTS = ["color", "size"]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def numbers(df):
    return [r["n"] for r in df.orderBy("snap_date").collect()]


@pytest.fixture()
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "store"))


def days(spark, rows):
    return spark.createDataFrame(rows, "snap_date date, n int")


def test_a_reload_is_one_version(spark, store):
    old = days(spark, [(date(2024, 1, 30), 1), (date(2024, 2, 3), 2), (date(2024, 2, 20), 3), (date(2024, 3, 1), 4)])
    assert store.version() == 0
    assert reload_version(store, "t", old, date(2024, 1, 1), date(2024, 4, 1)) == 1
    before = store.read("t")
    fresh = days(spark, [(date(2024, 2, 10), 9)])
    reload_version(store, "t", fresh, date(2024, 2, 1), date(2024, 2, 15))
    assert numbers(store.read("t")) == [1, 9, 3, 4]
    # An open reader keeps its version, and so does a reader of an earlier one.
    assert numbers(before) == [1, 2, 3, 4] == numbers(store.read("t", version=1))
    # The other months are the same files.
    assert {c: f for c, f in store.manifest(1)["t"]["folders"].items() if "-02-" not in c} == {
        c: f for c, f in store.manifest(2)["t"]["folders"].items() if "-02-" not in c
    }
    reload_version(store, "t", fresh.where("false"), date(2024, 2, 1), date(2024, 3, 1))
    assert store.chunks("t") == ["2024-01-01", "2024-03-01"] and numbers(store.read("t")) == [1, 4]
    assert all("2024-03-01" in f for f in store.read("t", ["2024-03-01"]).inputFiles())


def test_a_failed_reload_changes_nothing(spark, store, monkeypatch):
    old = days(spark, [(date(2024, 1, 30), 1), (date(2024, 2, 3), 2)])
    reload_version(store, "t", old, date(2024, 1, 1), date(2024, 3, 1))
    stray = days(spark, [(date(2024, 2, 4), 7), (date(2024, 5, 1), 8)])
    with pytest.raises(Exception, match="outside"):
        reload_version(store, "t", stray, date(2024, 2, 1), date(2024, 3, 1))
    assert store.version() == 1 and rows_of(store.read("t")) == rows_of(old)

    def fails(self, version, text):
        raise OSError("lost before the manifest")

    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", fails)
        with pytest.raises(OSError):
            reload_version(store, "t", old.where("n = 2"), date(2024, 1, 1), date(2024, 3, 1))
    assert store.version() == 1 and rows_of(store.read("t")) == rows_of(old)
    assert len(store.recover()) >= 1 and store.recover() == []
    assert rows_of(store.read("t")) == rows_of(old)
    reload_version(store, "t", old.where("n = 2"), date(2024, 1, 1), date(2024, 3, 1))
    assert rows_of(store.read("t")) == rows_of(old.where("n = 2"))


def test_a_change_that_came_between_is_an_error(spark, store):
    old = days(spark, [(date(2024, 1, 30), 1)])
    reload_version(store, "t", old, date(2024, 1, 1), date(2024, 3, 1))
    staged = store.stage(old, F.lit("2024-01-01"))
    reload_version(store, "t", old, date(2024, 1, 1), date(2024, 3, 1))
    with pytest.raises(RuntimeError, match="came after"):
        store.commit({"t": staged}, 1)


def facts(spark, seed=1, n=3000):
    rng = random.Random(seed)
    rows = [
        (date(2024, 1, 1) + timedelta(rng.randrange(100)), rng.choice([None, rng.gauss(0, 1), float("nan")]) if rng.random() < 0.1 else rng.gauss(0, 1), rng.choice(["red", "blue", None]), f"s{rng.randrange(30)}")
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, "day date, v double, color string, size string")


def close(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b, rel=1e-6, abs=1e-6, nan_ok=True) if not isinstance(a, tuple) else True
        for x, y in zip(a, b):
            assert x == (pytest.approx(y, rel=1e-6, abs=1e-6) if isinstance(y, float) else y), (a, b)


@pytest.mark.parametrize("func", ["mean", "size"])
def test_reloads_equal_the_full_run(spark, store, func):
    whole, wrong = facts(spark), facts(spark, 2)
    start, end = date(2024, 2, 10), date(2024, 3, 5)
    inside = F.col("day").between(start, end - timedelta(1))
    options = {"day": "day", "metric": "v", "func": func}
    gone = whole.where(~inside).unionByName(wrong.where(inside).withColumn("size", F.concat(F.lit("only before "), "size")))
    start_detector(store, gone, SEGMENTS, **options)
    reload_detector(store, whole, start, end, SEGMENTS, **options)
    reload_detector(store, whole, start, end, SEGMENTS, **options)
    got, want = stored_anomalies(store, SEGMENTS, func), segment_anomalies(whole, "day", "v", func, SEGMENTS)
    close(rows_of(got.significant), rows_of(want.significant))
    order = ["segment", "group", "day"]
    names = [*order, *sorted(set(want.scored.columns) - set(order))]
    close(got.scored.select(names).orderBy(order).collect(), want.scored.select(names).orderBy(order).collect())
    empty = whole.where("false")
    reload_detector(store, empty, date(2024, 1, 1), date(2025, 1, 1), SEGMENTS, **options)
    assert store.read(SCORED).count() == 0 and store.read(SUMS).count() == 0


def test_a_reload_reads_the_facts_and_the_edges_of_its_period(spark, store, tmp_path):
    facts(spark).write.parquet(str(tmp_path / "facts"))
    whole = spark.read.parquet(str(tmp_path / "facts"))
    options = {"day": "day", "metric": "v"}
    start_detector(store, whole, SEGMENTS, **options)
    before = store.manifest()
    period = whole.where((F.col("day") >= F.lit(date(2024, 2, 1))) & (F.col("day") < F.lit(date(2024, 3, 1))))
    plan = partial_sums(period, "day", "v", SEGMENTS)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(day" in plan and "LessThan(day" in plan and plan.count("FileScan") == 1
    reload_detector(store, whole.where((F.col("color") == "red") & (F.col("size") == "s1")), date(2024, 2, 1), date(2024, 2, 2), SEGMENTS, **options)
    after = store.manifest()
    same = [m for m, f in after[SUMS]["folders"].items() if before[SUMS]["folders"].get(m) == f]
    assert sorted(same) == ["2024-01-01", "2024-03-01", "2024-04-01"]


def test_sums_merge_in_any_cut(spark):
    whole = facts(spark)
    parts = partial_sums(whole.where("size < 's2'"), "day", "v", SEGMENTS).unionByName(partial_sums(whole.where("size >= 's2'"), "day", "v", SEGMENTS))
    for func in FROM_SUMS:
        key = ["segment", "group", "day"]
        got, want = (daily_of_sums(df, func).orderBy(key).collect() for df in (merged_sums(parts), partial_sums(whole, "day", "v", SEGMENTS)))
        close(got, want)
    with pytest.raises(ValueError, match="median"):
        daily_of_sums(parts, "median")
