"""Shape of the physical plans: what is pushed down, where rows are combined, what is never planned."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.ranking import average_ranks, value_ranks
from tidemark.operators.salting import hot_join
from tidemark.registry import QUERIES
from tidemark.registry.standins import charges, inquiries, inquiry_dimensions, subscriber_orders

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_or_nested_loop_join(spark, name):
    plan = plan_of(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_period_reaches_the_scan(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    from datetime import date

    from tidemark.functions.calendar import within_period

    plan = df.where(within_period("ts", date(2024, 1, 1), date(2024, 2, 1))).select("event_id")
    text = plan._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in text and "LessThan(ts" in text


def test_daily_metric_reads_three_columns(spark):
    plan = plan_of(entry.queries()["d1_daily_metric"](spark, SF))
    assert "ReadSchema: struct<l_discount:double,l_tax:double,l_shipdate:timestamp" in plan
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_avg" in plan


def test_group_series_scan_once_and_combine_before_the_shuffle(spark):
    plan = plan_of(entry.queries()["d2_group_daily"](spark, SF))
    assert plan.count("lineitem.parquet") == 1 and "Expand" in plan and "partial_avg" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_top_categories_are_cut_before_the_shuffle(spark):
    assert "WindowGroupLimit" in plan_of(entry.queries()["f3_top_categories"](spark, SF))


def test_top_groups_use_a_bounded_sort(spark):
    assert "TakeOrderedAndProject" in plan_of(entry.queries()["f2_top_groups"](spark, SF))


def test_charges_are_summed_before_the_join(spark):
    from datetime import date

    from tidemark.plans.vas import vas_usage

    df = vas_usage(subscriber_orders(spark, SF), charges(spark, SF), date(1995, 3, 1), date(2001, 1, 1))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("Join Inner")
    assert text.index("sum(CASE WHEN") > join


def test_counts_are_combined_before_the_dimensions(spark):
    from tidemark.operators.site_flags import cell_counts

    dims = inquiry_dimensions(spark, SF)
    text = cell_counts(inquiries(spark, SF), dims.cells, dims.organisations)._jdf.queryExecution().optimizedPlan().toString()
    assert text.rindex("Aggregate") > text.rindex("Join LeftOuter") and "count(1)" in text


def test_quantiles_of_a_hot_group(spark):
    """A third of all rows in one group, most of them one value."""
    rng = random.Random(1)
    rows = [("hot", rng.choice([1.0, rng.random(), -5e8])) for _ in range(3000)]
    rows += [(f"g{i % 40}", rng.gauss(0, 10)) for i in range(6000)] + [("one", 4.0), (None, 1.0), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    names = ["a", "b", "c", "d"]
    probs = [0.0, 0.25, 0.5, 0.99]
    for limit, bins in ((5, 16), (100, 4), (20_000, 64)):
        got = {r["g"]: [r[n] for n in names] for r in exact_quantiles(df, ["g"], "v", probs, names, bins, limit).collect()}
        want = df.where("g IS NOT NULL AND v IS NOT NULL").groupBy("g").agg(F.percentile("v", F.array(*[F.lit(p) for p in probs])).alias("q"))
        expected = {r["g"]: list(r["q"]) for r in want.collect()}
        assert got.keys() == expected.keys()
        for g, values in expected.items():
            assert got[g] == pytest.approx(values), g


def test_ranks_of_columns_sort_ranges(spark):
    """Mean ranks of many rows with ties, a hot value and nulls; nothing but one row a range is sorted in one task."""
    rng = random.Random(2)
    values = [rng.choice([7.0, 7.0, rng.random(), float(rng.randint(0, 3)), None]) for _ in range(4000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v double").repartition(5)
    got = {r["i"]: r["v_rank"] for r in average_ranks(df, ["v"]).collect()}
    known = sorted(v for v in values if v is not None)
    want = {i: bisect.bisect_left(known, v) + (known.count(v) + 1) / 2 for i, v in enumerate(values) if v is not None}
    assert got == want
    plan = plan_of(value_ranks(df, "v", "rank"))
    assert "rangepartitioning" not in plan and plan.count("Exchange SinglePartition") == 1 and "partial_sum" in plan


def test_hot_keys_are_joined_in_place(spark):
    rows = [(1 if i % 3 else i, i) for i in range(6000)]
    big = spark.createDataFrame(rows, "k long, i long")
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("i").alias("least"))
    joined = hot_join(big, small, ["k"], "n", 6000)
    least = {}
    for k, i in rows:
        least[k] = min(least.get(k, i), i)
    assert sorted(map(tuple, joined.collect())) == sorted((k, i, least[k]) for k, i in rows)
    assert "BroadcastHashJoin" in plan_of(joined)
