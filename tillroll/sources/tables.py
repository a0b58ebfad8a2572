"""Adapters from the star-schema tables (lineitem, orders, part, events ...) to
the shop concepts: order lines, catalog, and raw CSV text lines.

Only column projections and joins are declared here; Catalyst prunes every scan
to the referenced columns and pushes filters placed above these frames.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import zero_padded_sql


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``<sf_dir>/<name>.parquet`` as a DataFrame; its files are listed on every call."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines in the shop schema, one per ``lineitem`` row.

    ``order_id = l_orderkey``, ``customer_id = o_custkey``,
    ``product_id = l_partkey``, ``quantity = int(l_quantity)``,
    ``unit_price = l_extendedprice / l_quantity`` (so revenue recovers the line
    amount), ``country = n_name`` of the customer, ``order_date`` of the order.

    Join order: nation (a fixed dimension of 25 rows, the only hint) is attached to
    customers first, the result to orders, and only then the big lineitem side
    meets it on ``l_orderkey``, so the fact table crosses one shuffle. Which joins
    are broadcast is left to the byte sizes that the planner and AQE see.
    """
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    located = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "n_name")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    placed = orders.join(located, orders.o_custkey == located.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderdate", "n_name"
    )
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    return items.join(placed, items.l_orderkey == placed.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("n_name").alias("country"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("order_date"),
    )


def part_catalog(spark: SparkSession, sf_dir: str, category: str = "p_type") -> DataFrame:
    """Catalog from ``part``: id, name, category (``p_type`` or ``p_brand``), base price."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col(category).alias("category"),
        F.col("p_retailprice").alias("base_price"),
    )


def event_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The seven text fields of a transaction line, derived from ``events``.

    ``T`` + 7-digit event id, ``C`` + 5-digit user id, ``P`` + 4-digit product
    number taken from ``props``, quantity ``event_id % 5 + 1``, price at two
    decimals, event type as country, calendar day of ``ts``. ``position`` is the
    event id (dense), used by :func:`tillroll.sources.damage.corrupt_lines`.
    """
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "props", "value", "event_type", "ts")
    return ev.selectExpr(
        "event_id AS position",
        f"concat('T', {zero_padded_sql('event_id', 7)}) AS order_id",
        f"concat('C', {zero_padded_sql('user_id', 5)}) AS customer_id",
        f"concat('P', {zero_padded_sql(_PROPS_NUMBER, 4)}) AS product_id",
        "CAST(event_id % 5 + 1 AS STRING) AS quantity",
        "CAST(try_cast(value AS DECIMAL(38,2)) AS STRING) AS unit_price",
        "event_type AS country",
        "CAST(CAST(ts AS DATE) AS STRING) AS order_date",
    )


_PROPS_NUMBER = "try_cast(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


TRANSACTION_TEXT_FIELDS = (
    "order_id",
    "customer_id",
    "product_id",
    "quantity",
    "unit_price",
    "country",
    "order_date",
)


def event_lines(spark: SparkSession, sf_dir: str, *, corrupt: bool = True) -> DataFrame:
    """Raw transaction lines (``position, value``) built from ``events``;
    by default damaged like the reference's generated file."""
    from tillroll.sources.damage import corrupt_fields

    fields = event_fields(spark, sf_dir)
    if corrupt:
        fields = corrupt_fields(fields, list(TRANSACTION_TEXT_FIELDS), "position")
    return fenced_lines(fields, TRANSACTION_TEXT_FIELDS)


def fenced_lines(fields: DataFrame, columns=TRANSACTION_TEXT_FIELDS, position: str = "position") -> DataFrame:
    """``position, value``: the fields joined with commas, behind a fence.

    The one-row inline is an optimizer fence: a line filter placed above
    (empty / header lines) is evaluated on the built line instead of being
    pushed below with the whole line expression substituted into it.
    """
    line = f"concat_ws(',', {', '.join(f'`{c}`' for c in columns)})"
    return fields.selectExpr(f"inline(array(named_struct('position', `{position}`, 'value', {line})))")


def part_lines(spark: SparkSession, sf_dir: str, category: str = "p_type") -> DataFrame:
    """Raw catalog lines (``value``) built from ``part``: ``P`` + 4-digit key,
    name, category, price at two decimals."""
    p = table(spark, sf_dir, "part")
    line = (
        f"concat_ws(',', concat('P', {zero_padded_sql('p_partkey', 4)}), p_name, `{category}`, "
        "CAST(try_cast(p_retailprice AS DECIMAL(38,2)) AS STRING))"
    )
    return p.selectExpr(f"inline(array(named_struct('value', {line})))")
