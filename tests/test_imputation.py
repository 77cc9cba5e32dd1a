"""Nearest-neighbour and category imputation against brute force."""

import math
import random
import warnings

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import neighbours
from tidemark.operators.categories import category_impute, mode_impute
from tidemark.operators.neighbours import knn_impute
from tidemark.session import settled


def brute(rows, k=5):
    """rows: (key, values...); the answer by comparing every pair."""
    m = len(rows[0]) - 1
    means = []
    for j in range(m):
        seen = [r[j + 1] for r in rows if r[j + 1] is not None]
        means.append(sum(seen) / len(seen) if seen else None)
    out = {}
    for r in rows:
        filled = []
        for j in range(m):
            if r[j + 1] is not None:
                filled.append(r[j + 1])
                continue
            near = []
            for o in rows:
                both = [i for i in range(1, m + 1) if r[i] is not None and o[i] is not None]
                if o[j + 1] is not None and both:
                    near.append((math.sqrt(m / len(both) * sum((r[i] - o[i]) ** 2 for i in both)), o[0], o[j + 1]))
            best = sorted(near)[:k]
            filled.append(sum(v for _, _, v in best) / len(best) if best else means[j])
        out[r[0]] = filled
    return out


def check(spark, rows, k=5):
    names = [f"x{i}" for i in range(len(rows[0]) - 1)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names))
    got = {r["id"]: [r[n] for n in names] for r in knn_impute(df, "id", names, k).collect()}
    want = brute(rows, k)
    assert got.keys() == want.keys()
    for key, values in want.items():
        assert got[key] == pytest.approx(values, rel=1e-9, abs=1e-9), key


def gaps(rng, values, share):
    return [None if rng.random() < share else v for v in values]


def test_random_points(spark):
    rng = random.Random(3)
    check(spark, [(i, *gaps(rng, [rng.gauss(0, 1), rng.gauss(0, 50)], 0.2)) for i in range(400)])


def test_three_dimensions_and_patterns(spark):
    rng = random.Random(4)
    check(spark, [(i, *gaps(rng, [rng.random(), rng.random() * 3, rng.gauss(5, 2)], 0.25)) for i in range(300)])


def test_ties_and_hot_values(spark):
    """A third of all rows share one point, on both sides of the search."""
    rng = random.Random(5)
    rows = [(i, 1.0, None if i % 2 else float(i)) for i in range(200)]
    rows += [(i, float(rng.randint(0, 9)), None if i % 3 == 0 else float(rng.randint(0, 4))) for i in range(200, 600)]
    check(spark, rows)


def test_dense_cluster_beside_an_empty_area(spark):
    rng = random.Random(6)
    rows = [(i, 100 + rng.random() * 1e-3, rng.random()) for i in range(300)]
    rows += [(300 + i, rng.random(), None) for i in range(150)] + [(999, 1e6, 7.0)]
    check(spark, rows)


def test_far_dense_cluster_is_searched_by_its_edge(spark):
    """Receivers share no cell with the donors they need; crowded cells are split instead of met whole."""
    rng = random.Random(8)
    rows = [(i, 100 + rng.random() * 1e-3, rng.random() * 1e-3, rng.random()) for i in range(2500)]
    rows += [(5000 + i, rng.random(), rng.random(), None) for i in range(60)]
    check(spark, rows)


def test_points_closer_than_the_grid(spark):
    rng = random.Random(9)
    rows = [(i, 1.0 + i * 2**-52, rng.random()) for i in range(1200)] + [(9000, 1e9, 0.0), (9001, 1.0, None), (9002, 0.0, None)]
    check(spark, rows)


def test_twelve_columns_with_all_kinds_of_gaps(spark):
    rng = random.Random(10)
    rows = []
    for i in range(700):
        a, b = rng.gauss(0, 1), rng.gauss(0, 1)
        rows.append((i, *gaps(rng, [a * (j + 1) + b * (12 - j) + rng.gauss(0, 0.1) for j in range(12)], 0.15)))
    check(spark, rows)


def test_long_tails(spark):
    rng = random.Random(11)
    check(spark, [(i, *gaps(rng, [rng.lognormvariate(0, 3) for _ in range(3)], 0.2)) for i in range(900)])


def test_leaves_and_cells_of_any_size(spark, monkeypatch):
    """Small leaves and cells: many of both, receivers that share a cell with few donors, and one column that few have."""
    monkeypatch.setattr(neighbours, "LEAF", 7)
    monkeypatch.setattr(neighbours, "CELL_BITS", 2)
    monkeypatch.setattr(neighbours, "AT_A_TIME", 50)
    rng = random.Random(12)
    rows = [(i, *gaps(rng, [rng.choice([0.0, -0.0, 1.0, rng.gauss(0, 1)]), rng.random(), rng.gauss(5, 2)], 0.2), 3.5 if i % 97 == 0 else None) for i in range(400)]
    check(spark, rows)


def test_meetings_are_dealt_by_number_and_far_donors_stay(spark, monkeypatch):
    """The second meetings give no donor beyond the k-th distance of the first ones, in as many tasks as their number asks for."""
    monkeypatch.setattr(neighbours, "LEAF", 15)
    monkeypatch.setattr(neighbours, "TASK_ROWS", 50, raising=False)
    seen = []

    def kept(*args, found=neighbours._found):
        seen.append(settled(found(*args).withColumn("_task", F.spark_partition_id())))
        return seen[-1].drop("_task")

    monkeypatch.setattr(neighbours, "_found", kept)
    rng = random.Random(13)
    check(spark, [(i, *gaps(rng, [rng.random(), rng.random(), rng.random()], 0.2)) for i in range(400)])
    first, second = ([tuple(r) for r in df.select("_rid", "_c", "_d").collect()] for df in seen)
    reach = {}
    for rid, c, d in sorted(first):
        reach.setdefault((rid, c), []).append(d)
    assert second and all(len(r := reach.get((rid, c), [])) < 5 or d <= r[4] for rid, c, d in second)
    assert seen[1].select("_task").distinct().count() > 8


def test_least_distance_of_a_leaf_is_below_all_its_donors():
    rng = np.random.default_rng(5)
    for _ in range(30):
        donors, points = (np.where(rng.random((n, 5)) < 0.3, np.nan, rng.normal(size=(n, 5)) * [1, 5, 1, 2, 9]) for n in (60, 40))
        tree = neighbours.Tree.over(donors, 6)
        at = tree.leaf(donors)
        own = [donors[at == leaf] for leaf in np.unique(at)]
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            ranges = [np.array([f(x, axis=0) for x in own]) for f in (np.nanmin, np.nanmax)]
        leaves = neighbours.Leaves(np.unique(at), np.array(list(map(len, own))), *ranges, np.array([(~np.isnan(x)).sum(axis=0) for x in own]))
        least = leaves.least(points)
        for i, point in enumerate(points):
            for j, rows in enumerate(own):
                for row in rows:
                    both = ~np.isnan(point - row)
                    if both.any():
                        assert least[i, j] <= 5 / both.sum() * ((point - row)[both] ** 2).sum()


def test_distances_by_patterns_are_those_of_pairs(monkeypatch):
    """Also where a point shares no column with a donor, and where values are infinite."""
    rng = np.random.default_rng(4)
    points, donors = (np.where(rng.random((n, 3)) < 0.4, np.nan, rng.normal(size=(n, 3))) for n in (60, 90))
    for far in (False, True):
        if far:
            points[::7, 1], donors[::5, 1] = np.inf, np.inf
        both = ~np.isnan(points[:, None] - donors[None])
        with np.errstate(divide="ignore", invalid="ignore"):
            gaps = np.where(both, points[:, None] - donors[None], 0.0) ** 2
            want = np.where(both.any(axis=2), np.sqrt(3 / both.sum(axis=2) * gaps.sum(axis=2)), np.inf)
        there = neighbours._patterns(donors)
        assert np.array_equal(neighbours._distances(points, donors, [] if far else there), want)
        assert np.array_equal(neighbours._distances(points, donors, []), want)
        assert sorted(np.concatenate([rows for _, rows in there]).tolist()) == list(range(90))


def test_leaves_hold_one_pattern_where_gaps_are_not_rare():
    """A column missing in a tenth of the rows: no leaf of usual size mixes rows with and without it."""
    rng = np.random.default_rng(5)
    points = rng.normal(size=(4000, 2))
    points[rng.random(4000) < 0.1, 1] = np.nan
    leaf = neighbours.Tree.over(points, 40).leaf(points)
    share = [np.isnan(points[leaf == own, 1]).mean() for own in np.unique(leaf)]
    assert len(share) == 40 and set(share) == {0.0, 1.0}


def test_few_donors_and_empty_rows(spark):
    check(spark, [(1, 1.0, 2.0), (2, 3.0, 4.0), (3, 2.0, None), (4, None, None), (5, None, 1.0)])
    check(spark, [(1, None, 2.0), (2, 3.0, None), (3, 2.0, None)])


def test_one_column_takes_the_mean(spark):
    check(spark, [(1, 1.0), (2, None), (3, 5.0)])


def test_observed_cells_stay(spark):
    rng = random.Random(7)
    rows = [(i, *gaps(rng, [rng.random(), rng.random()], 0.3)) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a double, b double")
    joined = df.join(knn_impute(df, "id", ["a", "b"]).select("id", F.col("a").alias("fa"), F.col("b").alias("fb")), "id")
    assert joined.where("(a IS NOT NULL AND a <> fa) OR (b IS NOT NULL AND b <> fb) OR fa IS NULL OR fb IS NULL").count() == 0


def test_category_forest_learns_a_rule(spark):
    """Also in a session that has observed a table, as the report of a preparation does."""
    seen = Observation("rows")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}
    rows = [(i, float(i % 10), "u" if i % 2 else "v", None if i % 7 == 0 else ("low" if i % 10 < 5 else "high")) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, x double, s string, y string")
    filled = category_impute(df, "y", ["x", "s"], trees=10)
    assert filled.columns == df.columns and filled.count() == 400
    wrong = filled.where(F.col("y") != F.when(F.col("x") < 5, "low").otherwise("high"))
    assert wrong.count() == 0


def test_mode_of_the_group_and_of_the_table(spark):
    rows = [(1, "a", "p"), (2, "a", "p"), (3, "a", "q"), (4, "a", None), (5, "b", None), (6, None, None)]
    df = spark.createDataFrame(rows, "id long, g string, c string")
    assert {r["id"]: r["c"] for r in mode_impute(df, "c", ["g"]).collect()} == {1: "p", 2: "p", 3: "q", 4: "p", 5: None, 6: None}
    assert {r["c"] for r in mode_impute(df, "c").where("id > 3").collect()} == {"p"}
