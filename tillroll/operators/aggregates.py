"""Grouped revenue reports, order-size distribution and totals.

Every report is a declarative ``groupBy().agg()`` so Spark plans a partial
(map-side) hash aggregate before the shuffle: a key holding a third of all rows
costs one pre-aggregated row per input partition, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import money_sum, round_money
from tillroll.functions.sizes import DEFAULT_LIMITS, SIZE_LABELS, classify_order, size_dimension


def revenue_by_category(
    df: DataFrame,
    key: str = "category",
    *,
    amount: str = "revenue",
    quantity: str = "quantity",
) -> DataFrame:
    """Per key: exact revenue, number of lines (``orders``) and units sold."""
    return df.groupBy(key).agg(
        money_sum(amount).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(quantity).cast("long").alias("units_sold"),
    )


def revenue_by_country(df: DataFrame, key: str = "country", *, amount: str = "revenue") -> DataFrame:
    """Per key: exact revenue."""
    return df.groupBy(key).agg(money_sum(amount).alias("revenue"))


def spending_by_customer(df: DataFrame, key: str = "customer_id", *, amount: str = "revenue") -> DataFrame:
    """Per customer: exact total spent and number of lines."""
    return df.groupBy(key).agg(
        money_sum(amount).alias("total_spent"),
        F.count(F.lit(1)).alias("orders"),
    )


def order_size_distribution(
    df: DataFrame,
    *,
    amount: str = "revenue",
    limits: Sequence[float] = DEFAULT_LIMITS,
    labels: Sequence[str] = SIZE_LABELS,
) -> DataFrame:
    """Lines per size class; classes without lines are absent, NULL amounts are left out."""
    return df.where(F.col(amount).isNotNull()).groupBy(classify_order(amount, limits, labels).alias("size")).agg(F.expr("count(1) AS `count`"))


def order_size_zero_filled(
    df: DataFrame,
    *,
    amount: str = "revenue",
    limits: Sequence[float] = DEFAULT_LIMITS,
    labels: Sequence[str] = SIZE_LABELS,
) -> DataFrame:
    """All classes in rank order with their description; missing classes count 0.

    The distribution has at most ``len(labels)`` rows, so both sides of the
    final join are bounded by the number of classes.
    """
    counts = order_size_distribution(df, amount=amount, limits=limits, labels=labels)
    dim = size_dimension(df.sparkSession, limits, labels)
    return (
        dim.join(F.broadcast(counts), "size", "left")
        .selectExpr("rank", "size", "coalesce(`count`, CAST(0 AS BIGINT)) AS `count`", "description")
        .orderBy("rank")
    )


def total_revenue(df: DataFrame, *, amount: str = "revenue", alias: str = "total_revenue") -> DataFrame:
    """One row: exact sum of ``amount``; 0.0 over no rows (Spark's sum gives NULL)."""
    return df.agg(F.coalesce(money_sum(amount), F.lit(0.0)).alias(alias))


def grand_total_of_report(report: DataFrame, *, amount: str = "revenue", alias: str = "grand_total") -> DataFrame:
    """Rounded sum of a report's already-rounded amounts (second-level aggregate)."""
    return report.agg(round_money(F.coalesce(money_sum(amount), F.lit(0.0))).alias(alias))


def grouped_revenue_reports(
    df: DataFrame,
    *,
    category: str = "category",
    country: str = "country",
    customer: str = "customer_id",
    amount: str = "revenue",
    quantity: str = "quantity",
) -> DataFrame:
    """The category, country and customer aggregates in ONE pass.

    ``GROUPING SETS ((category), (country), (customer))``: Spark expands each
    row once per set and runs a single partial + final aggregation, so the
    input is read once instead of three times. Output: ``_set`` (``category``,
    ``country`` or ``customer``), the three key columns (NULL outside their
    set), ``revenue``, ``orders``, ``units_sold``. Split it with
    :func:`split_grouped_reports`.
    """
    grouped = df.groupingSets([[category], [country], [customer]], category, country, customer).agg(
        money_sum(amount).alias("revenue"),
        F.count(F.lit(1)).alias("orders"),
        F.sum(quantity).cast("long").alias("units_sold"),
        F.grouping_id().alias("_gid"),
    )
    # grouping_id bits follow the column order, first column most significant
    return grouped.select(
        F.when(F.col("_gid") == 3, F.lit("category"))
        .when(F.col("_gid") == 5, F.lit("country"))
        .otherwise(F.lit("customer"))
        .alias("_set"),
        category,
        country,
        customer,
        "revenue",
        "orders",
        "units_sold",
    )


def split_grouped_reports(
    grouped: DataFrame,
    *,
    category: str = "category",
    country: str = "country",
    customer: str = "customer_id",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(revenue_by_category, revenue_by_country, spending_by_customer)`` with
    the same columns as the separate reports."""
    cats = grouped.where(F.col("_set") == "category").select(category, "revenue", "orders", "units_sold")
    countries = grouped.where(F.col("_set") == "country").select(country, "revenue")
    customers = grouped.where(F.col("_set") == "customer").select(
        customer, F.col("revenue").alias("total_spent"), "orders"
    )
    return cats, countries, customers
