"""Registered queries over the driver tables, one per operator family.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame that reads the whole
tables; all are lazy but those that write what they read several times (the ordered
customers, the shared intermediates, the runs on files). Two families of input:

* the star-schema path: ``lineitem`` order lines joined to ``orders``,
  ``customer``, ``nation`` and the ``part`` catalog;
* the text path: CSV lines built from ``events`` (transactions, damaged like the
  reference's generated file) and ``part`` (catalog), parsed by the line
  validator; this is the reference's own six-report run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import render
from tillroll.functions.compose import chain, filter_k, identity, lift, then, zip_steps
from tillroll.functions.money import revenue_of
from tillroll.functions.sizes import classify_order
from tillroll.operators.aggregates import (
    grand_total_of_report,
    grouped_revenue_reports,
    order_size_distribution,
    order_size_zero_filled,
    revenue_by_category,
    revenue_by_country,
    spending_by_customer,
    total_revenue,
)
from tillroll.operators.enrich import enrich, keep_significant, shipped_to
from tillroll.operators.ordered import Ordered
from tillroll.operators.ranking import keys_to_reach, pareto, top_customers
from tillroll.plans.pipeline import PipelineConfig, PipelineRun, bucketed, build_run, report_row_counts, run_pipeline
from tillroll.sources.lines import (
    PRODUCT_HEADER,
    PRODUCT_SPEC,
    TRANSACTION_HEADER,
    TRANSACTION_SPEC,
    Outcomes,
    accepted,
    clean_lines,
    parse_lines,
    quality_summary,
    rejected,
    rejects_by_kind,
)
from tillroll.session import drop_folder, literal_table, shared_folder
from tillroll.sources.damage import corrupt_lines
from tillroll.sources.tables import (
    event_fields,
    event_lines,
    fenced_lines,
    part_catalog,
    part_lines,
    sales_lines,
    table,
)

# Parameters of the star-schema queries: line amounts there are ~100x the shop's,
# so the size bands and the significance threshold are scaled by 100.
LINEITEM_LIMITS = (5000.0, 20000.0, 100000.0)
LINEITEM_MIN_REVENUE = 2000.0
SHOP_MIN_REVENUE = 20.0
TOP_N = 20
PARETO_THRESHOLD = 80.0
SHIP_TO = ("NATION_0", "NATION_3", "NATION_7", "NATION_12", "NATION_24")

Query = Callable[[SparkSession, str], DataFrame]


# ----------------------------------------------------------------------------
# building blocks
# ----------------------------------------------------------------------------
def enriched_lines(spark: SparkSession, d: str, category: str = "p_type") -> DataFrame:
    return enrich(sales_lines(spark, d), part_catalog(spark, d, category), "product_id")


def significant_lines(spark: SparkSession, d: str, category: str = "p_type") -> DataFrame:
    return keep_significant(enriched_lines(spark, d, category), LINEITEM_MIN_REVENUE)


def category_report(spark: SparkSession, d: str, category: str = "p_type") -> DataFrame:
    return revenue_by_category(significant_lines(spark, d, category))


def customer_report(spark: SparkSession, d: str) -> DataFrame:
    return spending_by_customer(significant_lines(spark, d))


def _with_headers(lines: DataFrame, header: str) -> DataFrame:
    """The lines of a file as written: a header line, the body, an empty last line."""
    extra = literal_table(lines.sparkSession, [("value", "string")], [(header,), ("",)])
    return lines.select("value").unionByName(extra)


def shop_transaction_lines(spark: SparkSession, d: str) -> DataFrame:
    return _with_headers(event_lines(spark, d), TRANSACTION_HEADER)


def shop_product_lines(spark: SparkSession, d: str) -> DataFrame:
    return _with_headers(part_lines(spark, d), PRODUCT_HEADER)


def parsed_events(spark: SparkSession, d: str) -> DataFrame:
    return parse_lines(clean_lines(shop_transaction_lines(spark, d)), TRANSACTION_SPEC)


def shop_products(spark: SparkSession, d: str) -> DataFrame:
    return accepted(parse_lines(clean_lines(shop_product_lines(spark, d)), PRODUCT_SPEC), PRODUCT_SPEC)


def shop_enriched(spark: SparkSession, d: str) -> DataFrame:
    return enrich(accepted(parsed_events(spark, d)), shop_products(spark, d), "product_id")


def shop_significant(spark: SparkSession, d: str) -> DataFrame:
    return keep_significant(shop_enriched(spark, d), SHOP_MIN_REVENUE)


def shop_categories(spark: SparkSession, d: str) -> DataFrame:
    return revenue_by_category(shop_significant(spark, d))


# ----------------------------------------------------------------------------
# scans / parsing
# ----------------------------------------------------------------------------
def q_read_lines_count(spark: SparkSession, d: str) -> DataFrame:
    """Non-empty, non-header lines of the transaction and catalog text (headers and an empty line included in the input)."""
    def counted(lines: DataFrame, source: str) -> DataFrame:
        return clean_lines(lines).agg(F.count(F.lit(1)).alias("n_lines")).select(
            F.lit(source).alias("source"), "n_lines"
        )

    return counted(shop_transaction_lines(spark, d), "transactions").unionByName(
        counted(shop_product_lines(spark, d), "products")
    )


def q_accepted_lines(spark: SparkSession, d: str) -> DataFrame:
    """Accepted transaction records from the event text lines."""
    return accepted(parsed_events(spark, d))


def q_rejected_lines(spark: SparkSession, d: str) -> DataFrame:
    """Refused event text lines with their reasons."""
    return rejected(parsed_events(spark, d))


def outcomes_on_files(spark: SparkSession, d: str) -> Outcomes:
    """The parse of the event lines, written once, parted by outcome."""
    return Outcomes(parsed_events(spark, d), shared_folder(spark, "outcomes"))


def q_accepted_lines_on_files(spark: SparkSession, d: str) -> DataFrame:
    """Accepted records from the accepted part of the written parse."""
    return outcomes_on_files(spark, d).accepted


def q_rejected_lines_on_files(spark: SparkSession, d: str) -> DataFrame:
    """Refused lines from the refused part of the written parse."""
    return outcomes_on_files(spark, d).rejected


def q_quality_summary_observed(spark: SparkSession, d: str) -> DataFrame:
    """Accepted / rejected counts that the write of the parse observed."""
    return outcomes_on_files(spark, d).summary


def q_rejects_by_kind(spark: SparkSession, d: str) -> DataFrame:
    """Refused event text lines per error kind."""
    return rejects_by_kind(parsed_events(spark, d))


def q_quality_summary(spark: SparkSession, d: str) -> DataFrame:
    """Accepted / rejected line counts and the rejected share."""
    return quality_summary(parsed_events(spark, d))


def damaged_fields(spark: SparkSession, d: str) -> DataFrame:
    """Event fields with every kind of damage the validator must classify,
    chosen by position (each position is damaged or not; no row is dropped)."""
    f = event_fields(spark, d)
    p = F.col("position")
    tab = "\t"
    return f.select(
        "position",
        F.when(p % 1033 == 8, F.concat(F.lit(tab), F.col("order_id"), F.lit(" "))).otherwise(F.col("order_id")).alias("order_id"),
        F.when(p % 1013 == 4, F.lit("")).otherwise(F.col("customer_id")).alias("customer_id"),
        "product_id",
        F.when(p % 1009 == 3, F.lit("0"))
        .when(p % 1019 == 5, F.lit("-2"))
        .when(p % 1031 == 7, F.lit(" 3.9" + tab))
        .when(p % 1061 == 2, F.lit("1e1"))
        .otherwise(F.col("quantity"))
        .alias("quantity"),
        F.when(p % 1021 == 6, F.lit("abc"))
        .when(p % 1039 == 9, F.lit(""))
        .otherwise(F.col("unit_price"))
        .alias("unit_price"),
        F.when(p % 1049 == 10, F.lit("  ")).otherwise(F.col("country")).alias("country"),
        F.when(p % 1051 == 11, F.concat(F.col("order_date"), F.lit(",x"))).otherwise(F.col("order_date")).alias("order_date"),
    )


def q_rejects_all_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Every parse outcome on event lines damaged in all the ways the validator classifies."""
    lines = fenced_lines(damaged_fields(spark, d))
    # lines are cleaned as read, then damaged and parsed (the damage keeps every
    # line non-empty and header-free, so the order does not change the outcome)
    return parse_lines(corrupt_lines(clean_lines(lines), "position"), TRANSACTION_SPEC)


def q_products_accepted(spark: SparkSession, d: str) -> DataFrame:
    """Accepted catalog records from the part text lines."""
    return shop_products(spark, d)


# ----------------------------------------------------------------------------
# join, filters
# ----------------------------------------------------------------------------
def q_enrich_lines(spark: SparkSession, d: str) -> DataFrame:
    """lineitem order lines joined to the part catalog, with revenue."""
    return enriched_lines(spark, d)


def q_significant_lines(spark: SparkSession, d: str) -> DataFrame:
    """Enriched lines with revenue >= 2,000."""
    return significant_lines(spark, d)


def q_shipped_to_countries(spark: SparkSession, d: str) -> DataFrame:
    """Enriched lines shipped to five given nations (IN list pushed to the nation scan)."""
    return shipped_to(enriched_lines(spark, d), SHIP_TO)


def q_shop_enriched(spark: SparkSession, d: str) -> DataFrame:
    """Accepted event lines joined to the accepted catalog lines, with revenue."""
    return shop_enriched(spark, d)


def q_enrich_lines_shuffled(spark: SparkSession, d: str) -> DataFrame:
    """The same join as a sort-merge join whatever the table sizes."""
    return enrich(sales_lines(spark, d), part_catalog(spark, d), "product_id", join_hint="merge")


def q_enrich_lines_salted(spark: SparkSession, d: str) -> DataFrame:
    """The same join with every product spread over eight salts, as a sort-merge join."""
    return enrich(sales_lines(spark, d), part_catalog(spark, d), "product_id", join_hint="merge", salt_buckets=8)


# lineitem as order lines of which a third name one product and a quarter of the rest
# none of the catalog
CROWDED_COLUMNS = (
    "CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 4 = 1 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id",
    "l_orderkey AS order_id", "l_linenumber AS line", "CAST(l_quantity AS INT) AS quantity", "l_extendedprice / l_quantity AS unit_price",
)


def q_enrich_hot_product(spark: SparkSession, d: str) -> DataFrame:
    """Revenue and lines per category where one product is in a third of the lines: its
    lines alone are dealt over salts."""
    crowded = table(spark, d, "lineitem").selectExpr(*CROWDED_COLUMNS)
    joined = enrich(crowded, part_catalog(spark, d), "product_id", join_hint="merge", spread_hot=True)
    return revenue_by_category(joined)


def q_enrich_known_products(spark: SparkSession, d: str) -> DataFrame:
    """The same lines, those without a catalog row dropped before the shuffle."""
    crowded = table(spark, d, "lineitem").selectExpr(*CROWDED_COLUMNS)
    joined = enrich(crowded, part_catalog(spark, d), "product_id", join_hint="merge", spread_hot=True, prefilter=True)
    return order_size_distribution(joined, limits=LINEITEM_LIMITS)


def odd_priced_lines(spark: SparkSession, d: str) -> DataFrame:
    """Order lines of ``lineitem`` with some legal but extreme prices by position of
    the order: infinite, very large, and below a cent."""
    lines = table(spark, d, "lineitem").selectExpr(
        "l_returnflag AS category", "1 AS quantity",
        "CASE WHEN l_returnflag = 'A' AND l_orderkey % 97 = 5 THEN double('Infinity') "
        "WHEN l_returnflag = 'N' AND l_orderkey % 89 = 4 THEN 9e15D ELSE l_extendedprice END AS unit_price",
    )
    return lines.withColumn("revenue", revenue_of("quantity", "unit_price"))


def q_odd_prices_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Category report over lines with infinite and very large prices."""
    return revenue_by_category(odd_priced_lines(spark, d))


def q_small_amounts_total(spark: SparkSession, d: str) -> DataFrame:
    """Total of amounts below a cent, added first and rounded once."""
    return total_revenue(table(spark, d, "lineitem").selectExpr("l_quantity / 8192D AS revenue"))


# ----------------------------------------------------------------------------
# aggregations
# ----------------------------------------------------------------------------
def q_revenue_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Revenue, lines and units per part type over the significant lines."""
    return category_report(spark, d)


def q_revenue_by_country(spark: SparkSession, d: str) -> DataFrame:
    """Revenue per customer nation over the significant lines."""
    return revenue_by_country(significant_lines(spark, d))


def q_spending_by_customer(spark: SparkSession, d: str) -> DataFrame:
    """Total spent and lines per customer over the significant lines."""
    return customer_report(spark, d)


def q_spending_by_customer_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Total spent per customer from the join result written bucketed by customer."""
    kept = bucketed(enriched_lines(spark, d), "customer_id", shared_folder(spark, "enriched"), f"enriched_{uuid.uuid4().hex}")
    return spending_by_customer(keep_significant(kept, LINEITEM_MIN_REVENUE))


def q_grouped_revenue_reports(spark: SparkSession, d: str) -> DataFrame:
    """Category, country and customer aggregates of the significant lines in one
    grouping-sets pass."""
    return grouped_revenue_reports(significant_lines(spark, d))


def q_order_size_distribution(spark: SparkSession, d: str) -> DataFrame:
    """Lines per order-size class (limits x100) over all enriched lines."""
    return order_size_distribution(enriched_lines(spark, d), limits=LINEITEM_LIMITS)


def q_order_size_zero_filled(spark: SparkSession, d: str) -> DataFrame:
    """All four size classes for events.value, missing classes as 0."""
    amounts = table(spark, d, "events").select(F.col("value").alias("revenue"))
    return order_size_zero_filled(amounts)


def q_total_revenue(spark: SparkSession, d: str) -> DataFrame:
    """Exact total revenue of the significant lines (0.0 when none)."""
    return total_revenue(significant_lines(spark, d))


def q_grand_total_of_report(spark: SparkSession, d: str) -> DataFrame:
    """Rounded sum of the per-type report's revenues."""
    return grand_total_of_report(category_report(spark, d))


# ----------------------------------------------------------------------------
# ranking
# ----------------------------------------------------------------------------
def q_top_customers(spark: SparkSession, d: str) -> DataFrame:
    """The 20 customers who spent most (ties by key)."""
    return top_customers(significant_lines(spark, d), TOP_N)


def q_pareto_by_category(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative revenue share per part type (a short dimension: one window)."""
    return pareto(category_report(spark, d), "category", "revenue", method="window")


def q_pareto_by_brand(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative revenue share per brand (a short dimension: one window)."""
    return pareto(category_report(spark, d, "p_brand"), "category", "revenue", method="window")


def q_pareto_by_customer_ranged(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative share per customer via range partitions (many keys)."""
    return pareto(customer_report(spark, d), "customer_id", "total_spent", method="ranged")


def q_categories_up_to_80(spark: SparkSession, d: str) -> DataFrame:
    """How many leading part types reach 80 % of revenue."""
    return keys_to_reach(category_report(spark, d), PARETO_THRESHOLD, "category", "revenue", method="window")


def q_customers_up_to_80_ranged(spark: SparkSession, d: str) -> DataFrame:
    """How many leading customers reach 80 % of revenue (ranged)."""
    return keys_to_reach(
        customer_report(spark, d), PARETO_THRESHOLD, "customer_id", "total_spent", method="ranged"
    )


def ordered_customers(spark: SparkSession, d: str) -> Ordered:
    """The customer report, evaluated and written in order once."""
    return Ordered.of(customer_report(spark, d), "total_spent", "customer_id")


def q_pareto_by_customer_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Cumulative share per customer from rows written in order."""
    return ordered_customers(spark, d).pareto("customer_id")


def q_customers_up_to_80_prefix(spark: SparkSession, d: str) -> DataFrame:
    """How many leading customers reach 80 % of revenue: range totals, then one range."""
    return ordered_customers(spark, d).keys_to_reach(PARETO_THRESHOLD)


def q_top_half_of_customers(spark: SparkSession, d: str) -> DataFrame:
    """The half of all customers who spent most, cut without a task that holds it."""
    ordered = ordered_customers(spark, d)
    return ordered.first(ordered.rows.count() // 2)


def q_render_all_customers(spark: SparkSession, d: str) -> DataFrame:
    """The customer section for all customers, numbered from rows written in order."""
    return render.render_customers(ordered_customers(spark, d))


# ----------------------------------------------------------------------------
# composition
# ----------------------------------------------------------------------------
def q_composed_columns(spark: SparkSession, d: str) -> DataFrame:
    """then / zip / filter_k / chain / identity composed over event columns."""
    ev = table(spark, d, "events")
    hour = F.col("event_id") % 24
    to_minutes = lift(lambda c: c * 60)
    tag = lift(lambda c: F.concat(c.cast("string"), F.lit(" min")))
    next_hour = lift(lambda c: (c + 1) % 24)
    pair = zip_steps(next_hour, tag)(hour)
    size_label = lift(lambda c: c) >> (lambda c: classify_order(c))
    return ev.select(
        "event_id",
        then(to_minutes, tag)(hour).alias("minutes_text"),
        pair["_1"].alias("pair_next"),
        pair["_2"].alias("pair_text"),
        filter_k(to_minutes, lambda c: c >= 720)(hour).alias("afternoon_minutes"),
        chain([next_hour, next_hour, to_minutes])(hour).alias("chained"),
        chain([])(hour).alias("unchanged"),
        identity()(F.col("event_type")).alias("same_type"),
        size_label(F.col("value")).alias("size"),
    )


# ----------------------------------------------------------------------------
# the reference's own run over text lines: six reports and their rendering
# ----------------------------------------------------------------------------
def _shop_run(spark: SparkSession, d: str, config: PipelineConfig | None = None):
    """A single-consumer run by default (nothing materialized); pass a config
    with ``materialize="checkpoint"`` when several reports share the run."""
    return build_run(
        spark,
        config or PipelineConfig(single_pass_reports=False),
        transaction_lines=shop_transaction_lines(spark, d),
        product_lines=shop_product_lines(spark, d),
        cache=config is not None,
    )


def q_shop_revenue_by_category(spark: SparkSession, d: str) -> DataFrame:
    """The reference run's category report over the text lines."""
    return _shop_run(spark, d).report("revenue_by_category")


def q_shop_revenue_by_country(spark: SparkSession, d: str) -> DataFrame:
    """The reference run's country report over the text lines."""
    return _shop_run(spark, d).report("revenue_by_country")


def q_shop_top_customers(spark: SparkSession, d: str) -> DataFrame:
    """The reference run's top-20 customers over the text lines."""
    return _shop_run(spark, d).report("top_customers")


def q_shop_order_sizes(spark: SparkSession, d: str) -> DataFrame:
    """The reference run's zero-filled size distribution over the text lines."""
    return _shop_run(spark, d).report("order_sizes")


def q_shop_pareto_categories(spark: SparkSession, d: str) -> DataFrame:
    """The reference run's Pareto of categories over the text lines."""
    return _shop_run(spark, d).report("pareto_categories")


def q_text_files_run(spark: SparkSession, d: str) -> DataFrame:
    """The run on files: both inputs written as text to the shared folder, read by the
    text scan, the six reports written as CSV and their rows counted from the files."""
    base = shared_folder(spark, "text-run")
    config = PipelineConfig(data_dir=f"{base}/data", output_dir=f"{base}/output")
    shop_transaction_lines(spark, d).write.text(config.transactions_path)
    shop_product_lines(spark, d).write.text(config.products_path)
    run_pipeline(spark, config).close()
    counts = [
        spark.read.option("header", True).csv(config.report_path(name)).agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("report"), "n_rows")
        for name in PipelineRun.REPORTS
    ]
    found = [tuple(r) for r in reduce(DataFrame.unionByName, counts).collect()]  # one row a report
    drop_folder(spark, base)
    return literal_table(spark, [("report", "string"), ("n_rows", "bigint")], found)


def q_six_report_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Row count of each of the six reports of the text-line run. The parse and
    the join result are written once to the shared checkpoint folder and read by
    all six reports (instead of six recomputations)."""
    return report_row_counts(_shop_run(spark, d, PipelineConfig(materialize="checkpoint")))


def _text(name: str) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _shop_run(spark, d).text(name)

    run.__name__ = f"q_render_{name}"
    return run


QUERIES: dict[str, Query] = {
    "read_lines_count": q_read_lines_count,
    "accepted_lines": q_accepted_lines,
    "rejected_lines": q_rejected_lines,
    "accepted_lines_on_files": q_accepted_lines_on_files,
    "rejected_lines_on_files": q_rejected_lines_on_files,
    "quality_summary_observed": q_quality_summary_observed,
    "rejects_by_kind": q_rejects_by_kind,
    "quality_summary": q_quality_summary,
    "rejects_all_kinds": q_rejects_all_kinds,
    "products_accepted": q_products_accepted,
    "enrich_lines": q_enrich_lines,
    "significant_lines": q_significant_lines,
    "shipped_to_countries": q_shipped_to_countries,
    "shop_enriched": q_shop_enriched,
    "revenue_by_category": q_revenue_by_category,
    "revenue_by_country": q_revenue_by_country,
    "spending_by_customer": q_spending_by_customer,
    "spending_by_customer_bucketed": q_spending_by_customer_bucketed,
    "grouped_revenue_reports": q_grouped_revenue_reports,
    "order_size_distribution": q_order_size_distribution,
    "order_size_zero_filled": q_order_size_zero_filled,
    "total_revenue": q_total_revenue,
    "grand_total_of_report": q_grand_total_of_report,
    "top_customers": q_top_customers,
    "pareto_by_category": q_pareto_by_category,
    "pareto_by_brand": q_pareto_by_brand,
    "pareto_by_customer_ranged": q_pareto_by_customer_ranged,
    "categories_up_to_80": q_categories_up_to_80,
    "customers_up_to_80_ranged": q_customers_up_to_80_ranged,
    "pareto_by_customer_ordered": q_pareto_by_customer_ordered,
    "customers_up_to_80_prefix": q_customers_up_to_80_prefix,
    "top_half_of_customers": q_top_half_of_customers,
    "render_all_customers": q_render_all_customers,
    "composed_columns": q_composed_columns,
    "shop_revenue_by_category": q_shop_revenue_by_category,
    "shop_revenue_by_country": q_shop_revenue_by_country,
    "shop_top_customers": q_shop_top_customers,
    "shop_order_sizes": q_shop_order_sizes,
    "shop_pareto_categories": q_shop_pareto_categories,
    "six_report_row_counts": q_six_report_row_counts,
    "render_quality": _text("quality"),
    "render_categories": _text("categories"),
    "render_countries": _text("countries"),
    "render_customers": _text("customers"),
    "render_sizes": _text("sizes"),
    "render_pareto": _text("pareto"),
    "render_total": _text("total"),
    "enrich_lines_shuffled": q_enrich_lines_shuffled,
    "enrich_lines_salted": q_enrich_lines_salted,
    "enrich_hot_product": q_enrich_hot_product,
    "enrich_known_products": q_enrich_known_products,
    "odd_prices_by_category": q_odd_prices_by_category,
    "small_amounts_total": q_small_amounts_total,
    "text_files_run": q_text_files_run,
}
