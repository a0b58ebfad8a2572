"""Report text as DataFrames of ``line_no, line`` built with ``format_string``.

``format_string`` uses the JVM formatter with a fixed locale, so numbers render
the same on every executor. Money is cent-rounded before it is formatted.
Reports are ordered richest first, ties by key. How they are numbered is the caller's
choice: ``method="ranged"`` (the default) in one lazy plan without a single task,
``method="window"`` with one ordered window for a report that is short by construction
(categories, countries, a top list), or from an
:class:`tillroll.operators.ordered.Ordered` given in place of the report, whose rows were
written in order once. The size classes, a handful of rows, are numbered by their rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.money import round_money, round_money_sql
from tillroll.functions.text import sql_text
from tillroll.operators.ordered import Ordered
from tillroll.operators.ranking import framed_window, number_rows, share

# Fixed values that must equal the reference's: the line layouts.
CATEGORY_FORMAT = "%-14s %14.2f  %8d orders  %8d units"
COUNTRY_FORMAT = "%-14s %14.2f"
CUSTOMER_FORMAT = "%-10s %14.2f  %6d orders"
SIZE_FORMAT = "%-8s %10d lines  (%s)"
PARETO_FORMAT = "%-14s %14.2f  %6.2f %% cumulated"
FINDING_FORMAT = "FINDING: %d categories out of %d generate %.0f %% of it."
ACCEPTED_FORMAT = "accepted lines : %d"
REJECTED_FORMAT = "rejected lines : %d  (%.2f %% of the file)"
TOTAL_FORMAT = "total revenue of the analysed lines : %.2f"


def _numbered(report: DataFrame | Ordered, line: Column, score: str, key: str, method: str = "ranged") -> DataFrame:
    """``line_no, line`` by ``score`` descending, then ``key``."""
    if isinstance(report, Ordered):
        return report.numbered().select(F.col("_pos").alias("line_no"), line.alias("line"))
    if method not in ("ranged", "window"):
        raise ValueError(f"unknown numbering method {method!r}; use 'window' or 'ranged'")
    lines = report.select(score, key, line.alias("line"))
    if method == "ranged":
        return number_rows(lines, score, [key]).selectExpr("_pos AS line_no", "line")
    order = Window.orderBy(F.desc_nulls_last(score), F.asc(key))
    return lines.select(F.row_number().over(order).cast("long").alias("line_no"), "line")


def render_categories(report: DataFrame | Ordered, key: str = "category", *, method: str = "ranged") -> DataFrame:
    line = F.format_string(CATEGORY_FORMAT, F.col(key), round_money("revenue"), "orders", "units_sold")
    return _numbered(report, line, "revenue", key, method)


def render_countries(report: DataFrame | Ordered, key: str = "country", *, method: str = "ranged") -> DataFrame:
    line = F.format_string(COUNTRY_FORMAT, F.col(key), round_money("revenue"))
    return _numbered(report, line, "revenue", key, method)


def render_customers(report: DataFrame | Ordered, key: str = "customer_id", *, method: str = "ranged") -> DataFrame:
    line = F.format_string(CUSTOMER_FORMAT, F.col(key).cast("string"), round_money("total_spent"), "orders")
    return _numbered(report, line, "total_spent", key, method)


def render_sizes(zero_filled: DataFrame) -> DataFrame:
    """Lines of the zero-filled distribution (all classes, in rank order)."""
    line = F.format_string(SIZE_FORMAT, "size", "count", "description")
    return zero_filled.select((F.col("rank") + F.lit(1)).cast("long").alias("line_no"), line.alias("line"))


def _finding(needed: str, total: str, threshold: float) -> str:
    """SQL of the blank line and the FINDING line after ``total`` rows."""
    return (
        f"array(named_struct('line_no', CAST({total} + 1 AS BIGINT), 'line', ''), "
        f"named_struct('line_no', CAST({total} + 2 AS BIGINT), 'line', "
        f"format_string({sql_text(FINDING_FORMAT)}, {needed}, {total}, {float(threshold)!r}D)))"
    )


def render_short_pareto(report: DataFrame, threshold: float, key: str = "category", amount: str = "revenue") -> DataFrame:
    """:func:`render_pareto` from the category report itself, evaluated once: one window
    over a report that is short by construction, then one row with all its lines."""
    framed = framed_window(report, key, amount).withColumn("_share", share("_cum", "_total"))
    line = F.format_string(PARETO_FORMAT, F.col(key), round_money("_amt"), "_share")
    reached = F.when(F.col("_share") >= F.lit(float(threshold)), F.col("_pos"))
    one = framed.agg(
        F.array_sort(F.collect_list(F.struct(F.col("_pos").alias("line_no"), line.alias("line")))).alias("_lines"),
        F.coalesce(F.min(reached), F.count(F.lit(1))).alias("_needed"),
        F.count(F.lit(1)).alias("_n"),
    )
    return one.selectExpr(f"inline(concat(_lines, {_finding('_needed', '_n', threshold)}))")


def render_pareto(
    pareto_report: DataFrame, reach: DataFrame, threshold: float, key: str = "category"
) -> DataFrame:
    """Pareto rows, a blank line, then the FINDING line from :func:`keys_to_reach`."""
    rows = _numbered(
        pareto_report,
        F.format_string(PARETO_FORMAT, F.col(key), round_money("revenue"), "cumulative_share"),
        "revenue",
        key,
    )
    # the blank line and the FINDING line come from the one summary row
    tail = reach.selectExpr(f"inline({_finding('keys_needed', 'keys_total', threshold)})")
    return rows.unionByName(tail)


def render_quality(summary: DataFrame) -> DataFrame:
    """Two lines from :func:`tillroll.sources.lines.quality_summary` (one pass)."""
    share = round_money_sql("rejected_share")
    return summary.selectExpr(
        "inline(array("
        f"named_struct('line_no', CAST(1 AS BIGINT), 'line', format_string({sql_text(ACCEPTED_FORMAT)}, accepted)), "
        f"named_struct('line_no', CAST(2 AS BIGINT), 'line', format_string({sql_text(REJECTED_FORMAT)}, rejected, {share}))))"
    )


def render_total(total: DataFrame, column: str = "grand_total") -> DataFrame:
    """One line with the grand total of the category report."""
    return total.select(
        F.lit(1).cast("long").alias("line_no"),
        F.format_string(TOTAL_FORMAT, round_money(column)).alias("line"),
    )
