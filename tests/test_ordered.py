"""Ordered rows: even ranges, positions, running sums, prefixes and the place of a share."""

import random

import pytest
from pyspark.sql import functions as F

from tillroll.operators.ordered import Ordered
from tillroll.operators.ranking import keys_to_reach, number_rows, pareto, top_by


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def amounts(n, seed=1):
    rnd = random.Random(seed)
    return [(f"K{i:05d}", rnd.choice([0.0, 1.0, 5.25, 10.0, 10.0, 250.5, 999.99])) for i in range(n)]


@pytest.fixture(scope="module")
def report(spark):
    return spark.createDataFrame(amounts(3000), "key string, amount double").repartition(5)


@pytest.fixture(scope="module")
def ordered(report):
    with Ordered.of(report, "amount", "key", ranges=7) as o:
        yield o


def expected_order(rows):
    return sorted(rows, key=lambda r: (-r[1], r[0]))


def test_positions_need_no_shuffle(ordered):
    numbered = ordered.numbered()
    assert numbered.columns == ["key", "amount", "_pos"]
    got = sorted(numbered.collect(), key=lambda r: r["_pos"])
    assert [(r.key, r.amount) for r in got] == expected_order(amounts(3000))
    assert [r["_pos"] for r in got] == list(range(1, 3001))
    plan = plan_of(numbered)
    # only the ranges' totals, one row each, are exchanged, sorted or joined
    for line in plan.splitlines():
        if "Sort [" in line or "Window" in line:
            assert "_range" in line, line
    assert "SortMergeJoin" not in plan


def test_running_sums_equal_the_window(ordered, report):
    want = sorted(tuple(r) for r in pareto(report, "key", "amount", method="window").collect())
    assert sorted(tuple(r) for r in ordered.pareto("key").collect()) == want


@pytest.mark.parametrize("n", [-1, 0, 1, 400, 1500, 2999, 3000, 5000])
def test_prefixes(ordered, report, n):
    got = [tuple(r) for r in ordered.first(n).collect()]
    assert got == expected_order(amounts(3000))[: max(n, 0)]
    if n < 500:
        assert got == [tuple(r) for r in top_by(report, n, "amount", "key").collect()]


def test_half_of_the_rows_in_no_single_task(spark, ordered):
    merging = "spark.sql.adaptive.coalescePartitions.enabled"  # would merge so few rows
    spark.conf.set(merging, "false")
    try:
        sizes = [r["count"] for r in ordered.first(1500).groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset(merging)
    assert sum(sizes) == 1500 and max(sizes) < 2 * 1500 / 8
    assert max(r["_n"] for r in ordered.totals().collect()) < 2 * 3000 / 7


@pytest.mark.parametrize("threshold", [0.0, 10.0, 50.0, 79.99, 80.0, 99.99, 100.0, 100.01])
def test_place_of_a_share(ordered, report, threshold):
    want = keys_to_reach(report, threshold, "key", "amount", method="window").first()
    assert ordered.keys_to_reach(threshold).first() == want


def test_only_the_crossing_range_is_read(ordered):
    found = ordered.keys_to_reach(80.0)
    plan = plan_of(found)
    assert plan.count("FileScan parquet") == 1
    assert "PushedFilters: [IsNotNull(_at), GreaterThanOrEqual(_at," in plan and "LessThan(_at," in plan


def test_negative_amounts_fall_after_the_peak(spark):
    df = spark.createDataFrame([("A", 50.0), ("B", 40.0), ("C", -30.0), ("D", 40.0), ("E", -0.5)], "key string, amount double")
    for ranges in (1, 2, 4):
        with Ordered.of(df, "amount", "key", ranges=ranges) as o:
            for t in (10.0, 90.0, 120.0, 130.0, 140.0):
                assert o.keys_to_reach(t).first() == keys_to_reach(df, t, "key", "amount", method="window").first()
    down = df.where("amount < 0")
    with Ordered.of(down, "amount", "key") as o:
        assert o.keys_to_reach(80.0).first() == keys_to_reach(down, 80.0, "key", "amount", method="window").first()
        assert {r.cumulative_share for r in o.pareto("key").collect()} == {0.0}


def test_one_value_in_a_third_of_the_rows(spark):
    """The largest range stays below twice the mean, with ties parted by keys, by other
    columns, and, where rows are equal in every column, by their copies."""
    n = 24000
    base = spark.range(n).selectExpr("id AS key", "IF(id % 3 = 0, 77D, CAST(xxhash64(id) % 100000 AS DOUBLE)) AS amount")
    for df, keys, copies in ((base, "key", False), (base, (), False), (base.select("amount"), (), True)):
        with Ordered.of(df.repartition(6), "amount", keys, ranges=16, split_copies=copies) as o:
            sizes = [r["_n"] for r in o.totals().collect()]
            assert sum(sizes) == n and max(sizes) < 2 * n / 16
            got = o.numbered().orderBy("_pos").collect()
            assert [r.amount for r in got] == sorted((r.amount for r in df.collect()), reverse=True)
            assert o.columns == df.columns
    sizes = [r["count"] for r in _lazy_ranges(base.repartition(6), 16)]
    assert max(sizes) < 2 * n / 16


def _lazy_ranges(df, ranges):
    from tillroll.operators.ranking import _ranged

    return _ranged(df, "amount", [], ranges).groupBy("_range").count().collect()


def test_odd_scores_and_empty_input(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([("a", None), ("b", nan), ("c", inf), ("d", -inf), ("e", 0.0), (None, 0.0), ("f", None)], "key string, s double")
    with Ordered.of(df, "s", "key", ranges=3) as o:
        assert [r.key for r in o.first(10).collect()] == ["b", "c", None, "e", "d", "a", "f"]
        assert {r.key: r["_pos"] for r in o.numbered().collect()} == {
            r.key: r["_pos"] for r in number_rows(df, "s", ["key"], ranges=3).collect()}
    with Ordered.of(df.limit(0), "s", "key") as o:
        assert o.numbered().count() == 0 and o.first(5).count() == 0 and o.pareto("key").count() == 0
        assert tuple(o.keys_to_reach(80.0).first()) == (0, 0)


def test_one_evaluation_of_the_input(spark):
    """Four reports read the written rows; the input runs once (and its sample)."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    grouped = spark.range(1000).mapInArrow(count, "id long").selectExpr("id % 200 AS key", "CAST(id AS DOUBLE) AS v").groupBy("key").sum("v")
    with Ordered.of(grouped.withColumnRenamed("sum(v)", "amount"), "amount", "key", ranges=4) as o:
        o.numbered().collect(), o.pareto("key").collect(), o.first(100).collect(), o.keys_to_reach(50.0).collect()
    assert seen.value == 1000


def test_reserved_names(spark, report):
    with pytest.raises(ValueError):
        Ordered.of(report.withColumn("_range", F.lit(1)), "amount", "key")


def test_release_deletes_the_folder(spark, report):
    import os

    o = Ordered.of(report, "amount", "key")
    place = o.path.removeprefix("file:")
    assert os.path.isdir(place)
    o.release()
    assert not os.path.isdir(place)
