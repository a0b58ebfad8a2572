"""The ranged Pareto (no single-partition window) equals the window Pareto."""

import random

import pytest

from tillroll.operators.ranking import keys_to_reach, pareto
from tillroll.plans.queries import customer_report


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("ranges", [1, 3, 8, 50])
def test_ranged_equals_window_with_ties(spark, ranges):
    rnd = random.Random(ranges)
    data = [(f"K{i:04d}", float(rnd.choice([0, 1, 5, 10, 10, 250, 999]) + rnd.choice([0.0, 0.25]))) for i in range(500)]
    df = spark.createDataFrame(data, "key string, amount double")
    w = pareto(df, "key", "amount", method="window")
    r = pareto(df, "key", "amount", method="ranged", ranges=ranges)
    assert _rows(w) == _rows(r)
    for t in (10.0, 50.0, 80.0, 100.0):
        assert keys_to_reach(df, t, "key", "amount", method="window").first() == keys_to_reach(
            df, t, "key", "amount", method="ranged", ranges=ranges
        ).first()


def test_ranged_equals_window_on_customers(spark):
    report = customer_report(spark, "/root/testdata/sf0.01")
    w = pareto(report, "customer_id", "total_spent", method="window")
    r = pareto(report, "customer_id", "total_spent", method="ranged", ranges=8)
    rows = _rows(r)
    assert rows == _rows(w)
    assert max(x[2] for x in rows) == 100.0


def test_ranged_with_negative_amounts_uses_positions(spark):
    data = [("A", 50.0), ("B", 40.0), ("C", -30.0), ("D", 40.0)]
    df = spark.createDataFrame(data, "key string, amount double")
    for method in ("window", "ranged"):
        got = keys_to_reach(df, 90.0, "key", "amount", method=method, ranges=2).first()
        # shares: A 50/100, B 90/100 -> 2 keys; later rows are not looked at
        assert (got.keys_needed, got.keys_total) == (2, 4)


def test_default_pareto_gathers_no_report_rows(spark):
    report = customer_report(spark, "/root/testdata/sf0.01")
    plan = pareto(report, "customer_id", "total_spent")._jdf.queryExecution().sparkPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    # only the offsets, one row per range, are ordered as a whole
    assert all("_range" in line or "_c_sum#" in line for line in windows) and len(windows) >= 2
