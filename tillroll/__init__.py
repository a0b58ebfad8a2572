"""tillroll: sales-line analytics on Spark DataFrames.

Every operator takes DataFrames plus column names / thresholds and returns a DataFrame
built from native expressions, lazy but for those that say they write (``Ordered``,
``Outcomes``, the report writers); no rows are collected to the driver.
"""

from tillroll.functions.money import cents, money_sum, revenue_of, round_money
from tillroll.functions.sizes import classify_order, describe_size, size_dimension
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
from tillroll.operators.ordered import Ordered
from tillroll.operators.ranking import keys_to_reach, number_rows, pareto, top_by, top_customers
from tillroll.sources.lines import (
    PRODUCT_SPEC,
    TRANSACTION_SPEC,
    Outcomes,
    accepted,
    clean_lines,
    is_header,
    parse_lines,
    quality_summary,
    read_lines,
    rejected,
    rejects_by_kind,
)
from tillroll.sources.sinks import finish_run, write_report, write_reports

__all__ = [
    "Ordered",
    "Outcomes",
    "PRODUCT_SPEC",
    "TRANSACTION_SPEC",
    "accepted",
    "at_least_revenue",
    "cents",
    "classify_order",
    "clean_lines",
    "describe_size",
    "enrich",
    "finish_run",
    "grand_total_of_report",
    "is_header",
    "keep_significant",
    "keys_to_reach",
    "money_sum",
    "number_rows",
    "order_size_distribution",
    "order_size_zero_filled",
    "pareto",
    "parse_lines",
    "quality_summary",
    "read_lines",
    "rejected",
    "rejects_by_kind",
    "revenue_by_category",
    "revenue_by_country",
    "revenue_of",
    "round_money",
    "shipped_to",
    "size_dimension",
    "spending_by_customer",
    "top_by",
    "top_customers",
    "total_revenue",
    "write_report",
    "write_reports",
]
