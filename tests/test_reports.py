"""Join, filter and report rules on a small hand-computed shop."""

import pytest
from pyspark.sql import functions as F

from tillroll.functions.sizes import classify_order, describe_limits, size_dimension
from tillroll.operators.aggregates import (
    grand_total_of_report,
    order_size_distribution,
    order_size_zero_filled,
    revenue_by_category,
    revenue_by_country,
    spending_by_customer,
    total_revenue,
)
from tillroll.operators.enrich import at_least_revenue, enrich, keep_significant, shipped_to
from tillroll.operators.ranking import keys_to_reach, number_rows, pareto, top_by, top_customers

PRODUCTS = [
    ("A10", "Oak Desk", "Furniture", 120.5),
    ("A11", "Wool Scarf", "Apparel", 18.25),
    ("A12", "Field Lens", "Optics", 640.0),
]
TRANSACTIONS = [
    ("L1", "K7", "A11", 2, 18.25, "Peru", "2023-05-02"),
    ("L2", "K7", "A10", 1, 120.5, "Peru", "2023-05-02"),
    ("L3", "K8", "A12", 2, 640.0, "Norway", "2023-05-03"),
    ("L4", "K9", "A11", 4, 18.0, "Norway", "2023-05-04"),
    ("L5", "K8", "A10", 3, 119.0, "Peru", "2023-05-04"),
]
TX_SCHEMA = "order_id string, customer_id string, product_id string, quantity int, unit_price double, country string, order_date string"
PR_SCHEMA = "product_id string, product_name string, category string, base_price double"


@pytest.fixture
def enriched(spark):
    tx = spark.createDataFrame(TRANSACTIONS, TX_SCHEMA)
    pr = spark.createDataFrame(PRODUCTS, PR_SCHEMA)
    return enrich(tx, pr)


def test_enrich(enriched):
    rows = enriched.orderBy("order_id").collect()
    assert [r.revenue for r in rows] == [36.5, 120.5, 1280.0, 72.0, 357.0]
    assert "product_id" not in enriched.columns and "base_price" not in enriched.columns
    assert rows[3].product_name == "Wool Scarf" and rows[3].unit_price == 18.0


def test_enrich_drops_unknown_and_fans_out_duplicates(spark):
    tx = spark.createDataFrame(TRANSACTIONS + [("L9", "K1", "A99", 1, 1.0, "Chad", "d")], TX_SCHEMA)
    pr = spark.createDataFrame(PRODUCTS + [("A11", "Silk Scarf", "Apparel", 40.0)], PR_SCHEMA)
    out = enrich(tx, pr)
    assert out.count() == 7  # L9 vanishes, L1 and L4 meet two A11 rows
    assert out.where("order_id = 'L9'").count() == 0


def test_enrich_salted_and_shuffled_equal_default(spark):
    tx = spark.createDataFrame(TRANSACTIONS * 50, TX_SCHEMA)
    pr = spark.createDataFrame(PRODUCTS, PR_SCHEMA)
    base = sorted(enrich(tx, pr).collect())
    merged = enrich(tx, pr, join_hint="merge", salt_buckets=4)
    assert "SortMergeJoin" in merged._jdf.queryExecution().sparkPlan().toString()
    assert sorted(merged.collect()) == base
    assert sorted(enrich(tx, pr, join_hint="merge").collect()) == base


def test_keep_significant(enriched):
    assert sorted(r.order_id for r in keep_significant(enriched, 120.5).collect()) == ["L2", "L3", "L5"]


def test_revenue_by_category(enriched):
    got = {r.category: (r.revenue, r.orders, r.units_sold) for r in revenue_by_category(enriched).collect()}
    assert got == {"Apparel": (108.5, 2, 6), "Furniture": (477.5, 2, 4), "Optics": (1280.0, 1, 2)}


def test_revenue_by_country(enriched):
    got = {r.country: r.revenue for r in revenue_by_country(enriched).collect()}
    assert got == {"Peru": 514.0, "Norway": 1352.0}


def test_top_customers(enriched):
    rows = top_customers(enriched, 2).collect()
    assert [(r.customer_id, r.total_spent, r.orders) for r in rows] == [("K8", 1637.0, 2), ("K7", 157.0, 2)]
    assert top_customers(enriched, 10).count() == 3
    assert top_customers(enriched, 0).count() == 0


def test_order_size_distribution(enriched):
    got = {r["size"]: r["count"] for r in order_size_distribution(enriched).collect()}
    assert got == {"SMALL": 1, "MEDIUM": 2, "LARGE": 1, "PREMIUM": 1}


def test_order_size_zero_filled(enriched):
    rows = order_size_zero_filled(enriched.where("revenue > 100")).collect()
    assert [(r["size"], r["count"]) for r in rows] == [("SMALL", 0), ("MEDIUM", 1), ("LARGE", 1), ("PREMIUM", 1)]
    assert rows[1].description == "between 50.0 and 200.0"


def test_null_amounts_have_no_class(spark):
    df = spark.createDataFrame([(None,), (7.0,), (None,)], "revenue double")
    assert [r[0] for r in df.select(classify_order("revenue")).collect()] == [None, "SMALL", None]
    assert [r[0] for r in df.select(classify_order(F.col("revenue"))).collect()] == [None, "SMALL", None]
    assert [(r["size"], r["count"]) for r in order_size_distribution(df).collect()] == [("SMALL", 1)]


def test_zero_fill_of_single_class(spark):
    df = spark.createDataFrame([(10.0,)] * 7, "revenue double")
    rows = order_size_zero_filled(df).collect()
    assert len(rows) == 4 and (rows[0]["size"], rows[0]["count"]) == ("SMALL", 7)


def test_pareto_of_fixture(enriched):
    rows = pareto(revenue_by_category(enriched)).orderBy(F.desc("revenue"), "category").collect()
    assert [(r.category, r.cumulative_share) for r in rows] == [("Optics", 68.6), ("Furniture", 94.19), ("Apparel", 100.0)]


def test_classify_boundaries(spark):
    values = [10.0, 49.99, 50.0, 199.99, 200.0, 999.99, 1000.0, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(classify_order("x")).collect()]
    assert got == ["SMALL", "SMALL", "MEDIUM", "MEDIUM", "LARGE", "LARGE", "PREMIUM", "PREMIUM"]


def test_descriptions():
    assert describe_limits() == [
        "below 50.0 dollars",
        "between 50.0 and 200.0",
        "between 200.0 and 1000.0",
        "at least 1000.0 dollars",
    ]
    assert describe_limits((5000.0, 2e7, 1e8))[1] == "between 5000.0 and 2.0E7"


def test_size_dimension(spark):
    rows = size_dimension(spark).collect()
    assert [r["size"] for r in rows] == ["SMALL", "MEDIUM", "LARGE", "PREMIUM"]
    assert rows[0].lower is None and rows[3].upper is None and rows[1].lower == 50.0


def test_predicates(spark):
    df = spark.createDataFrame([(31.0, "Peru"), (8.5, "Chad"), (float("nan"), "Norway")], "revenue double, country string")
    assert [r.revenue for r in df.where(at_least_revenue(20.0)).collect()] == [31.0]
    assert [r.country for r in shipped_to(df, ["Chad", "Fiji"]).collect()] == ["Chad"]
    wanted = spark.createDataFrame([("Peru",), ("Norway",), ("Norway",)], "c string")
    assert sorted(r.country for r in shipped_to(df, wanted).collect()) == ["Norway", "Peru"]


def test_total_revenue(spark):
    df = spark.createDataFrame([(1.0,)] * 200_000, "revenue double")
    assert total_revenue(df).first()[0] == 200000.0
    assert total_revenue(df.where("revenue > 5")).first()[0] == 0.0


def test_fold_of_one_group(spark):
    df = spark.createDataFrame([("Tea", 4.75, 3), ("Tea", 0.5, 2)], "category string, revenue double, quantity int")
    r = revenue_by_category(df).first()
    assert (r.revenue, r.orders, r.units_sold) == (5.25, 2, 5)


def test_top_by(spark):
    df = spark.createDataFrame([(2.5,), (-1.0,), (8.0,), (4.0,)], "s double")
    assert [r.s for r in top_by(df, 2, "s").collect()] == [8.0, 4.0]
    assert top_by(df, 10, "s").count() == 4
    assert top_by(df, -1, "s").count() == 0


@pytest.fixture
def pareto_input(spark):
    return spark.createDataFrame([("Tea", 40.0), ("Maps", 150.0), ("Ink", 40.0), ("Rope", 20.0)], "category string, revenue double")


@pytest.mark.parametrize("method", ["window", "ranged"])
def test_pareto_example(pareto_input, method):
    rows = pareto(pareto_input, method=method, ranges=2).orderBy(F.desc("revenue"), "category").collect()
    assert [(r.category, r.cumulative_share) for r in rows] == [("Maps", 60.0), ("Ink", 76.0), ("Tea", 92.0), ("Rope", 100.0)]


@pytest.mark.parametrize("method", ["window", "ranged"])
def test_keys_to_reach(pareto_input, method):
    assert keys_to_reach(pareto_input, 76.0, method=method, ranges=2).first().keys_needed == 2
    assert keys_to_reach(pareto_input, 100.0, method=method, ranges=2).first().keys_needed == 4
    r = keys_to_reach(pareto_input.where("revenue < 0"), 80.0).first()
    assert (r.keys_needed, r.keys_total) == (0, 0)


def test_pareto_zero_total_and_empty(spark):
    zero = spark.createDataFrame([("A", 0.0), ("B", 0.0)], "category string, revenue double")
    assert {r.cumulative_share for r in pareto(zero).collect()} == {0.0}
    assert pareto(zero.where("revenue > 1")).count() == 0


def test_grand_total_of_report(enriched):
    assert grand_total_of_report(revenue_by_category(enriched)).first()[0] == 1866.0


def test_sums_agree_across_reports(enriched):
    by_cat = sum(r.revenue for r in revenue_by_category(enriched).collect())
    by_cty = sum(r.revenue for r in revenue_by_country(enriched).collect())
    by_cus = sum(r.total_spent for r in spending_by_customer(enriched).collect())
    assert by_cat == by_cty == by_cus == 1866.0


def test_numbered_rows_equal_the_ordered_top(spark):
    import random

    rnd = random.Random(3)
    rows = [(f"K{i:04d}", rnd.choice([1.0, 2.0, 2.0, 3.0, 50.0, 50.0, 99.0, float("nan"), None])) for i in range(400)]
    df = spark.createDataFrame(rows, "key string, s double")
    for n in (0, 1, 37, 400, 1000):
        top = [r.key for r in top_by(df, n, "s", "key").collect()]
        cut = number_rows(df, "s", ["key"], ranges=7).where(F.col("_pos") <= n).orderBy("_pos")
        assert [r.key for r in cut.collect()] == top


def test_declaring_ranked_results_starts_no_job(spark):
    df = spark.range(1000).selectExpr("CAST(id AS STRING) AS key", "CAST(id % 17 AS DOUBLE) AS s")
    tracker, group = spark.sparkContext.statusTracker(), "declared-only"
    spark.sparkContext.setJobGroup(group, group)
    try:
        top_by(df, 10**6, "s", "key")
        number_rows(df, "s", ["key"])
        pareto(df, "key", "s")
        keys_to_reach(df, 50.0, "key", "s")
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
