"""DuckDB SQL twins of the registered queries (the correctness oracle).

Plain SQL over the pre-registered table views. Money follows the same rules: JVM
``Math.round`` cents (the same expression as the Spark side's, so the rule itself is
checked in ``tests/test_money.py``) and exact BIGINT-cent sums; ties broken by key.
"""

from __future__ import annotations

# ----------------------------------------------------------------------------
# SQL fragments
# ----------------------------------------------------------------------------


def rm(x: str) -> str:
    """``Math.round(x * 100) / 100.0`` in SQL."""
    s = f"(({x}) * 100.0)"
    return (
        f"((CASE WHEN abs({s}) < 4503599627370496.0 "
        f"THEN floor({s}) + CASE WHEN {s} - floor({s}) >= 0.5 THEN 1 ELSE 0 END "
        f"ELSE floor({s}) END) / 100.0)"
    )


def ms(x: str) -> str:
    """Exact money sum over cent-rounded amounts."""
    return f"(sum(CAST(round(({x}) * 100.0) AS BIGINT)) / 100.0)"


def cents(x: str) -> str:
    return f"CAST(round(({x}) * 100.0) AS BIGINT)"


SALES = """
located AS (
  SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey),
placed AS (
  SELECT o_orderkey, o_custkey, o_orderdate, n_name FROM orders JOIN located ON o_custkey = c_custkey),
sales AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(trunc(l_quantity) AS INTEGER) AS quantity,
         l_extendedprice / l_quantity AS unit_price,
         n_name AS country, strftime(o_orderdate, '%Y-%m-%d') AS order_date
  FROM lineitem JOIN placed ON l_orderkey = o_orderkey)"""


def enriched_cte(category: str = "p_type") -> str:
    return (
        SALES
        + f""",
enriched AS (
  SELECT s.order_id, s.customer_id, s.quantity, s.unit_price, s.country, s.order_date,
         p.p_name AS product_name, p.{category} AS category,
         {rm('s.quantity * s.unit_price')} AS revenue
  FROM sales s JOIN part p ON s.product_id = p.p_partkey)"""
    )


def significant_cte(category: str = "p_type", threshold: float = 2000.0) -> str:
    return (
        enriched_cte(category)
        + f""",
significant AS (SELECT * FROM enriched WHERE revenue >= {threshold} AND NOT isnan(revenue))"""
    )


def category_report_cte(category: str = "p_type", source: str = "significant") -> str:
    return f""",
report AS (
  SELECT category, {ms('revenue')} AS revenue, count(*) AS orders,
         CAST(sum(quantity) AS BIGINT) AS units_sold
  FROM {source} GROUP BY category)"""


def customer_report_cte(source: str = "significant") -> str:
    return f""",
spending AS (
  SELECT customer_id, {ms('revenue')} AS total_spent, count(*) AS orders
  FROM {source} GROUP BY customer_id)"""


def framed_cte(src: str, key: str, amount: str) -> str:
    order = f"{amount} DESC, {key} ASC"
    return f""",
framed AS (
  SELECT {key}, {amount} AS amt,
         sum({cents(amount)}) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         sum({cents(amount)}) OVER () AS total,
         row_number() OVER (ORDER BY {order}) AS pos
  FROM {src}),
shared AS (
  SELECT {key}, amt, pos,
         CASE WHEN total <= 0 THEN 0.0 ELSE {rm('cum / total * 100.0')} END AS share
  FROM framed)"""


def pareto_select(key: str) -> str:
    return f"SELECT {key}, {rm('amt')} AS revenue, share AS cumulative_share FROM shared"


def reach_select(threshold: float) -> str:
    return (
        f"SELECT CAST(coalesce(min(CASE WHEN share >= {threshold} THEN pos END), count(*)) AS BIGINT) AS keys_needed, "
        f"count(*) AS keys_total FROM shared"
    )


# --- text path ---------------------------------------------------------------

EVENT_FIELDS = r"""
ev AS (
  SELECT event_id AS position,
         printf('T%07d', event_id) AS order_id,
         printf('C%05d', user_id) AS customer_id,
         printf('P%04d', CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER)) AS product_id,
         CAST(event_id % 5 + 1 AS VARCHAR) AS quantity,
         CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) AS unit_price,
         event_type AS country,
         strftime(ts, '%Y-%m-%d') AS order_date
  FROM events)"""


def damaged_lines_cte(src: str = "ev") -> str:
    """Lines with the reference's damage by position: N/A price, dropped last field."""
    return f""",
tx_lines AS (
  SELECT CASE
    WHEN position > 0 AND position % 977 = 0
      THEN concat_ws(',', order_id, customer_id, product_id, quantity, 'N/A', country, order_date)
    WHEN position > 977 AND position % 2931 = 1
      THEN concat_ws(',', order_id, customer_id, product_id, quantity, unit_price, country)
    ELSE concat_ws(',', order_id, customer_id, product_id, quantity, unit_price, country, order_date)
  END AS value
  FROM {src}
  UNION ALL SELECT 'orderId,customerId,productId,quantity,unitPrice,country,orderDate'
  UNION ALL SELECT '')"""


PART_LINES = """,
pr_lines AS (
  SELECT concat_ws(',', printf('P%04d', p_partkey), p_name, p_type,
                   CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR)) AS value
  FROM part
  UNION ALL SELECT 'productId,productName,category,basePrice'
  UNION ALL SELECT '')"""

TX_FIELDS = [
    ("orderId", "order_id", "text"),
    ("customerId", "customer_id", "text"),
    ("productId", "product_id", "text"),
    ("quantity", "quantity", "int"),
    ("unitPrice", "unit_price", "num"),
    ("country", "country", "text"),
    ("orderDate", "order_date", "text"),
]
PR_FIELDS = [
    ("productId", "product_id", "text"),
    ("productName", "product_name", "text"),
    ("category", "category", "text"),
    ("basePrice", "base_price", "num"),
]

TRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def jvm_double(x: str) -> str:
    return (
        f"(CASE WHEN regexp_matches(lower({x}), '^[+-]?(inf|infinity|nan)$') "
        f"AND NOT regexp_matches({x}, '^[+-]?(NaN|Infinity)$') THEN NULL "
        f"ELSE TRY_CAST({x} AS DOUBLE) END)"
    )


def parsed_cte(name: str, src: str, fields) -> str:
    """Validate-or-reject every non-empty, non-header line of ``src``."""
    n = len(fields)
    trims = ",\n         ".join(
        TRIM.format(x=f"parts[{i + 1}]") + f" AS f{i}" for i in range(n)
    )
    nums = ",\n         ".join(
        jvm_double(f"f{i}") + f" AS d{i}" for i, f in enumerate(fields) if f[2] != "text"
    )
    kind_cases = [f"WHEN n <> {n} THEN 'WrongFieldCount'"]
    reason_cases = [f"WHEN n <> {n} THEN 'expected {n} fields but found ' || CAST(n AS VARCHAR)"]
    for i, (label, _col, kind) in enumerate(fields):
        if kind == "text":
            kind_cases.append(f"WHEN f{i} = '' THEN 'MissingField'")
            reason_cases.append(f"WHEN f{i} = '' THEN 'field {label} is empty'")
        else:
            kind_cases.append(f"WHEN d{i} IS NULL THEN 'NotANumber'")
            reason_cases.append(f"WHEN d{i} IS NULL THEN 'field {label} is not a number: ''' || f{i} || ''''")
            kind_cases.append(f"WHEN d{i} <= 0 THEN 'OutOfRange'")
            reason_cases.append(f"WHEN d{i} <= 0 THEN 'field {label} is out of range: ''' || f{i} || ''''")
    values = []
    for i, (_label, col, kind) in enumerate(fields):
        if kind == "text":
            v = f"f{i}"
        elif kind == "num":
            v = f"d{i}"
        else:
            v = f"(CASE WHEN isnan(d{i}) THEN 0 ELSE CAST(trunc(least(d{i}, 2147483647.0)) AS INTEGER) END)"
        values.append(f"CASE WHEN reason IS NULL THEN {v} END AS {col}")
    return f""",
{name}_split AS (
  SELECT value AS line, string_split(value, ',') AS parts, len(string_split(value, ',')) AS n
  FROM {src}
  WHERE length(value) > 0 AND NOT (starts_with(value, 'orderId') OR starts_with(value, 'productId'))),
{name}_trim AS (
  SELECT line, n,
         {trims}
  FROM {name}_split),
{name}_num AS (
  SELECT *,
         {nums}
  FROM {name}_trim),
{name}_checked AS (
  SELECT *,
         CASE {' '.join(kind_cases)} END AS error_kind,
         CASE {' '.join(reason_cases)} END AS reason
  FROM {name}_num),
{name} AS (
  SELECT line, error_kind, reason,
         {(','+chr(10)+'         ').join(values)}
  FROM {name}_checked)"""


TX_COLS = ", ".join(c for _l, c, _k in TX_FIELDS)
PR_COLS = ", ".join(c for _l, c, _k in PR_FIELDS)

PARSED_EVENTS = "WITH " + EVENT_FIELDS + damaged_lines_cte() + parsed_cte("parsed", "tx_lines", TX_FIELDS)

SHOP = (
    PARSED_EVENTS
    + PART_LINES
    + parsed_cte("pparsed", "pr_lines", PR_FIELDS)
    + f""",
products AS (SELECT {PR_COLS} FROM pparsed WHERE reason IS NULL),
txs AS (SELECT {TX_COLS} FROM parsed WHERE reason IS NULL),
shop_enriched AS (
  SELECT t.order_id, t.customer_id, t.quantity, t.unit_price, t.country, t.order_date,
         p.product_name, p.category, {rm('t.quantity * t.unit_price')} AS revenue
  FROM txs t JOIN products p ON t.product_id = p.product_id),
shop_significant AS (SELECT * FROM shop_enriched WHERE revenue >= 20.0 AND NOT isnan(revenue))"""
)

SIZE_DIM_DEFAULT = """
SELECT * FROM (VALUES
  (0, 'SMALL', 'below 50.0 dollars'),
  (1, 'MEDIUM', 'between 50.0 and 200.0'),
  (2, 'LARGE', 'between 200.0 and 1000.0'),
  (3, 'PREMIUM', 'at least 1000.0 dollars')) AS t(rank, size, description)"""


def classify(x: str, limits=(50.0, 200.0, 1000.0)) -> str:
    a, b, c = limits
    return f"CASE WHEN {x} < {a} THEN 'SMALL' WHEN {x} < {b} THEN 'MEDIUM' WHEN {x} < {c} THEN 'LARGE' ELSE 'PREMIUM' END"


def zero_filled(source: str, amount: str) -> str:
    return f""",
dist AS (SELECT {classify(amount)} AS size, count(*) AS cnt FROM {source} GROUP BY 1),
dim AS ({SIZE_DIM_DEFAULT})
SELECT CAST(dim.rank AS INTEGER) AS rank, dim.size, CAST(coalesce(dist.cnt, 0) AS BIGINT) AS count, dim.description
FROM dim LEFT JOIN dist ON dim.size = dist.size"""


# ----------------------------------------------------------------------------
# the queries
# ----------------------------------------------------------------------------
ORACLE: dict[str, str] = {}

ORACLE["read_lines_count"] = (
    "WITH "
    + EVENT_FIELDS
    + damaged_lines_cte()
    + PART_LINES
    + """
SELECT 'transactions' AS source, count(*) AS n_lines FROM tx_lines
  WHERE length(value) > 0 AND NOT (starts_with(value, 'orderId') OR starts_with(value, 'productId'))
UNION ALL
SELECT 'products' AS source, count(*) AS n_lines FROM pr_lines
  WHERE length(value) > 0 AND NOT (starts_with(value, 'orderId') OR starts_with(value, 'productId'))"""
)

ORACLE["accepted_lines"] = PARSED_EVENTS + f"\nSELECT {TX_COLS} FROM parsed WHERE reason IS NULL"
ORACLE["rejected_lines"] = PARSED_EVENTS + "\nSELECT reason, line FROM parsed WHERE reason IS NOT NULL"
ORACLE["rejects_by_kind"] = (
    PARSED_EVENTS + "\nSELECT error_kind, count(*) AS count FROM parsed WHERE reason IS NOT NULL GROUP BY error_kind"
)
ORACLE["quality_summary"] = (
    PARSED_EVENTS
    + """
SELECT accepted, rejected,
       CASE WHEN accepted + rejected <= 0 THEN 0.0 ELSE CAST(rejected AS DOUBLE) * 100.0 / (accepted + rejected) END AS rejected_share
FROM (SELECT count(*) FILTER (WHERE reason IS NULL) AS accepted,
             count(*) FILTER (WHERE reason IS NOT NULL) AS rejected FROM parsed)"""
)

_DAMAGED = r""",
dmg AS (
  SELECT position,
    CASE WHEN position % 1033 = 8 THEN chr(9) || order_id || ' ' ELSE order_id END AS order_id,
    CASE WHEN position % 1013 = 4 THEN '' ELSE customer_id END AS customer_id,
    product_id,
    CASE WHEN position % 1009 = 3 THEN '0'
         WHEN position % 1019 = 5 THEN '-2'
         WHEN position % 1031 = 7 THEN ' 3.9' || chr(9)
         WHEN position % 1061 = 2 THEN '1e1'
         ELSE quantity END AS quantity,
    CASE WHEN position % 1021 = 6 THEN 'abc'
         WHEN position % 1039 = 9 THEN ''
         ELSE unit_price END AS unit_price,
    CASE WHEN position % 1049 = 10 THEN '  ' ELSE country END AS country,
    CASE WHEN position % 1051 = 11 THEN order_date || ',x' ELSE order_date END AS order_date
  FROM ev),
dmg_lines AS (
  SELECT CASE
    WHEN position > 0 AND position % 977 = 0
      THEN concat_ws(',', order_id, customer_id, product_id, quantity, 'N/A', country,
                     order_date)
    WHEN position > 977 AND position % 2931 = 1
      THEN array_to_string(list_slice(string_split(concat_ws(',', order_id, customer_id, product_id, quantity, unit_price, country, order_date), ','), 1, -2), ',')
    ELSE concat_ws(',', order_id, customer_id, product_id, quantity, unit_price, country, order_date)
  END AS value
  FROM dmg)"""

ORACLE["rejects_all_kinds"] = (
    "WITH " + EVENT_FIELDS + _DAMAGED + parsed_cte("parsed", "dmg_lines", TX_FIELDS) + "\nSELECT * FROM parsed"
)

ORACLE["products_accepted"] = (
    "WITH " + PART_LINES.lstrip(",\n") + parsed_cte("pparsed", "pr_lines", PR_FIELDS)
    + f"\nSELECT {PR_COLS} FROM pparsed WHERE reason IS NULL"
)

ORACLE["enrich_lines"] = "WITH " + enriched_cte() + "\nSELECT * FROM enriched"
ORACLE["significant_lines"] = "WITH " + significant_cte() + "\nSELECT * FROM significant"
ORACLE["shipped_to_countries"] = (
    "WITH " + enriched_cte()
    + "\nSELECT * FROM enriched WHERE country IN ('NATION_0', 'NATION_3', 'NATION_7', 'NATION_12', 'NATION_24')"
)
ORACLE["shop_enriched"] = SHOP + "\nSELECT * FROM shop_enriched"

ORACLE["revenue_by_category"] = "WITH " + significant_cte() + category_report_cte() + "\nSELECT * FROM report"
ORACLE["revenue_by_country"] = (
    "WITH " + significant_cte() + f"\nSELECT country, {ms('revenue')} AS revenue FROM significant GROUP BY country"
)
ORACLE["spending_by_customer"] = "WITH " + significant_cte() + customer_report_cte() + "\nSELECT * FROM spending"
ORACLE["order_size_distribution"] = (
    "WITH " + enriched_cte()
    + f"\nSELECT {classify('revenue', (5000.0, 20000.0, 100000.0))} AS size, count(*) AS count FROM enriched GROUP BY 1"
)
CROWDED = f"""
lines AS (
  SELECT CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 4 = 1 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id,
         CAST(l_quantity AS INTEGER) AS quantity, l_extendedprice / l_quantity AS unit_price
  FROM lineitem),
crowded AS (
  SELECT p.p_type AS category, quantity, {rm('quantity * unit_price')} AS revenue
  FROM lines JOIN part p ON lines.product_id = p.p_partkey)"""
ORACLE["enrich_hot_product"] = (
    "WITH " + CROWDED + category_report_cte(source="crowded") + "\nSELECT category, revenue, orders, units_sold FROM report"
)
ORACLE["enrich_known_products"] = (
    "WITH " + CROWDED
    + f"\nSELECT {classify('revenue', (5000.0, 20000.0, 100000.0))} AS size, count(*) AS count FROM crowded GROUP BY 1"
)
ORACLE["order_size_zero_filled"] = (
    "WITH amounts AS (SELECT value AS revenue FROM events)" + zero_filled("amounts", "revenue")
)
ORACLE["total_revenue"] = (
    "WITH " + significant_cte() + f"\nSELECT coalesce({ms('revenue')}, 0.0) AS total_revenue FROM significant"
)
ORACLE["grand_total_of_report"] = (
    "WITH " + significant_cte() + category_report_cte()
    + f"\nSELECT {rm('coalesce(' + ms('revenue') + ', 0.0)')} AS grand_total FROM report"
)
ORACLE["top_customers"] = (
    "WITH " + significant_cte() + customer_report_cte()
    + "\nSELECT * FROM spending ORDER BY total_spent DESC, customer_id ASC LIMIT 20"
)
ORACLE["pareto_by_category"] = (
    "WITH " + significant_cte() + category_report_cte() + framed_cte("report", "category", "revenue")
    + "\n" + pareto_select("category")
)
ORACLE["pareto_by_brand"] = (
    "WITH " + significant_cte("p_brand") + category_report_cte() + framed_cte("report", "category", "revenue")
    + "\n" + pareto_select("category")
)
ORACLE["pareto_by_customer_ranged"] = (
    "WITH " + significant_cte() + customer_report_cte() + framed_cte("spending", "customer_id", "total_spent")
    + "\n" + pareto_select("customer_id")
)
ORACLE["categories_up_to_80"] = (
    "WITH " + significant_cte() + category_report_cte() + framed_cte("report", "category", "revenue")
    + "\n" + reach_select(80.0)
)
ORACLE["customers_up_to_80_ranged"] = (
    "WITH " + significant_cte() + customer_report_cte() + framed_cte("spending", "customer_id", "total_spent")
    + "\n" + reach_select(80.0)
)
ORACLE["pareto_by_customer_ordered"] = ORACLE["pareto_by_customer_ranged"]
ORACLE["customers_up_to_80_prefix"] = ORACLE["customers_up_to_80_ranged"]
ORACLE["top_half_of_customers"] = (
    "WITH " + significant_cte() + customer_report_cte()
    + """
SELECT customer_id, total_spent, orders FROM (
  SELECT *, row_number() OVER (ORDER BY total_spent DESC, customer_id ASC) AS pos, count(*) OVER () AS n FROM spending)
WHERE pos <= n // 2"""
)
ORACLE["render_all_customers"] = (
    "WITH " + significant_cte() + customer_report_cte()
    + f"""
SELECT row_number() OVER (ORDER BY total_spent DESC, customer_id ASC) AS line_no,
       printf('%-10s %14.2f  %6d orders', CAST(customer_id AS VARCHAR), {rm('total_spent')}, orders) AS line
FROM spending"""
)
ORACLE["accepted_lines_on_files"] = ORACLE["accepted_lines"]
ORACLE["rejected_lines_on_files"] = ORACLE["rejected_lines"]
ORACLE["quality_summary_observed"] = ORACLE["quality_summary"]
ORACLE["spending_by_customer_bucketed"] = ORACLE["spending_by_customer"]
ORACLE["composed_columns"] = f"""
SELECT event_id,
       CAST((event_id % 24) * 60 AS VARCHAR) || ' min' AS minutes_text,
       (event_id % 24 + 1) % 24 AS pair_next,
       CAST(event_id % 24 AS VARCHAR) || ' min' AS pair_text,
       CASE WHEN (event_id % 24) * 60 >= 720 THEN (event_id % 24) * 60 END AS afternoon_minutes,
       (((event_id % 24 + 1) % 24 + 1) % 24) * 60 AS chained,
       event_id % 24 AS unchanged,
       event_type AS same_type,
       {classify('value')} AS size
FROM events"""
ORACLE["enrich_lines_shuffled"] = ORACLE["enrich_lines"]
ORACLE["enrich_lines_salted"] = ORACLE["enrich_lines"]
# prices here are whole cents below 2**53 but for the odd ones; an infinite price is
# worth 2**63 cents, and any sum of more than that many cents counts as that many
ORACLE["odd_prices_by_category"] = """
SELECT category, least(sum(c), 9223372036854775807) / 100.0 AS revenue, count(*) AS orders, count(*) AS units_sold
FROM (SELECT l_returnflag AS category,
             CASE WHEN l_returnflag = 'A' AND l_orderkey % 97 = 5 THEN CAST(9223372036854775807 AS HUGEINT)
                  WHEN l_returnflag = 'N' AND l_orderkey % 89 = 4 THEN CAST(900000000000000000 AS HUGEINT)
                  ELSE CAST(round(l_extendedprice * 100) AS HUGEINT) END AS c FROM lineitem)
GROUP BY category"""
# the quantities are whole: the sum is a whole number of 8192nds
ORACLE["small_amounts_total"] = """
SELECT floor(CAST(sum(CAST(l_quantity AS BIGINT)) AS DOUBLE) / 8192.0 * 100.0 + 0.5) / 100.0 AS total_revenue FROM lineitem"""

# --- the reference's six-report run over the text lines ----------------------
SHOP_REPORT = SHOP + category_report_cte(source="shop_significant")
ORACLE["shop_revenue_by_category"] = SHOP_REPORT + "\nSELECT * FROM report"
ORACLE["shop_revenue_by_country"] = (
    SHOP + f"\nSELECT country, {ms('revenue')} AS revenue FROM shop_significant GROUP BY country"
)
_SHOP_SPENDING = SHOP + customer_report_cte(source="shop_significant")
ORACLE["shop_top_customers"] = (
    _SHOP_SPENDING + "\nSELECT * FROM spending ORDER BY total_spent DESC, customer_id ASC LIMIT 20"
)
ORACLE["shop_order_sizes"] = (
    SHOP + zero_filled("shop_enriched", "revenue").replace(
        "SELECT CAST(dim.rank AS INTEGER) AS rank, dim.size, CAST(coalesce(dist.cnt, 0) AS BIGINT) AS count, dim.description",
        "SELECT dim.size, CAST(coalesce(dist.cnt, 0) AS BIGINT) AS count",
    )
)
_SHOP_FRAMED = SHOP_REPORT + framed_cte("report", "category", "revenue")
ORACLE["shop_pareto_categories"] = _SHOP_FRAMED + "\n" + pareto_select("category")
ORACLE["six_report_row_counts"] = (
    SHOP_REPORT
    + """,
spending AS (SELECT customer_id FROM shop_significant GROUP BY customer_id)
SELECT 'revenue_by_category' AS report, count(*) AS n_rows FROM report
UNION ALL SELECT 'revenue_by_country', count(DISTINCT country) FROM shop_significant
UNION ALL SELECT 'top_customers', least(count(*), 20) FROM spending
UNION ALL SELECT 'order_sizes', count(*) FROM (VALUES ('SMALL'), ('MEDIUM'), ('LARGE'), ('PREMIUM')) sizes(label)
UNION ALL SELECT 'pareto_categories', count(*) FROM report
UNION ALL SELECT 'rejected_lines', count(*) FROM parsed WHERE reason IS NOT NULL"""
)

# rendered text sections (line_no, line)
ORACLE["render_quality"] = (
    PARSED_EVENTS
    + f""",
q AS (SELECT count(*) FILTER (WHERE reason IS NULL) AS accepted,
             count(*) FILTER (WHERE reason IS NOT NULL) AS rejected FROM parsed),
s AS (SELECT accepted, rejected,
             CASE WHEN accepted + rejected <= 0 THEN 0.0
                  ELSE CAST(rejected AS DOUBLE) * 100.0 / (accepted + rejected) END AS share FROM q)
SELECT CAST(1 AS BIGINT) AS line_no, printf('accepted lines : %d', accepted) AS line FROM s
UNION ALL
SELECT CAST(2 AS BIGINT), printf('rejected lines : %d  (%.2f %% of the file)', rejected, {rm('share')}) FROM s"""
)
ORACLE["render_categories"] = (
    SHOP_REPORT
    + f"""
SELECT row_number() OVER (ORDER BY revenue DESC, category ASC) AS line_no,
       printf('%-14s %14.2f  %8d orders  %8d units', category, {rm('revenue')}, orders, units_sold) AS line
FROM report"""
)
ORACLE["render_countries"] = (
    SHOP
    + f""",
c AS (SELECT country, {ms('revenue')} AS revenue FROM shop_significant GROUP BY country)
SELECT row_number() OVER (ORDER BY revenue DESC, country ASC) AS line_no,
       printf('%-14s %14.2f', country, {rm('revenue')}) AS line
FROM c"""
)
ORACLE["render_customers"] = (
    _SHOP_SPENDING
    + f""",
top AS (SELECT * FROM spending ORDER BY total_spent DESC, customer_id ASC LIMIT 20)
SELECT row_number() OVER (ORDER BY total_spent DESC, customer_id ASC) AS line_no,
       printf('%-10s %14.2f  %6d orders', customer_id, {rm('total_spent')}, orders) AS line
FROM top"""
)
ORACLE["render_sizes"] = (
    SHOP
    + zero_filled("shop_enriched", "revenue").replace(
        "SELECT CAST(dim.rank AS INTEGER) AS rank, dim.size, CAST(coalesce(dist.cnt, 0) AS BIGINT) AS count, dim.description",
        "SELECT CAST(dim.rank + 1 AS BIGINT) AS line_no, "
        "printf('%-8s %10d lines  (%s)', dim.size, CAST(coalesce(dist.cnt, 0) AS BIGINT), dim.description) AS line",
    )
)
ORACLE["render_pareto"] = (
    _SHOP_FRAMED
    + f""",
reach AS ({reach_select(80.0)})
SELECT pos AS line_no, printf('%-14s %14.2f  %6.2f %% cumulated', category, {rm('amt')}, share) AS line FROM shared
UNION ALL SELECT keys_total + 1, '' FROM reach
UNION ALL SELECT keys_total + 2,
  printf('FINDING: %d categories out of %d generate %.0f %% of it.', keys_needed, keys_total, 80.0) FROM reach"""
)
ORACLE["render_total"] = (
    SHOP_REPORT
    + f"""
SELECT CAST(1 AS BIGINT) AS line_no,
       printf('total revenue of the analysed lines : %.2f', {rm(rm('coalesce(' + ms('revenue') + ', 0.0)'))}) AS line
FROM report"""
)


ORACLE["grouped_revenue_reports"] = (
    "WITH " + significant_cte()
    + f"""
SELECT CASE GROUPING(category, country, customer_id) WHEN 3 THEN 'category' WHEN 5 THEN 'country' ELSE 'customer' END AS _set,
       category, country, customer_id,
       {ms('revenue')} AS revenue, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold
FROM significant
GROUP BY GROUPING SETS ((category), (country), (customer_id))"""
)

ORACLE["text_files_run"] = ORACLE["six_report_row_counts"]
