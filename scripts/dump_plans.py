"""Write the physical plans of representative queries to
docs/plans.md. Usage: python scripts/dump_plans.py [sf_dir]"""

from __future__ import annotations

import contextlib
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

from tillroll.plans.queries import QUERIES  # noqa: E402
from tillroll.session import ensure_checkpoint_dir  # noqa: E402

SHOWN = {
    "revenue_by_category": "star schema: lineitem x orders x customer x nation x part -> >= 2000 -> per type",
    "top_customers": "top-k over an aggregate",
    "grouped_revenue_reports": "category, country and customer aggregates in one grouping-sets pass (one Expand, one shuffle)",
    "pareto_by_customer_ranged": "Pareto over 15k customers without a single-partition window",
    "pareto_by_category": "Pareto of a short dimension: one window, one evaluation",
    "pareto_by_customer_ordered": "Pareto from rows written in order once",
    "customers_up_to_80_prefix": "the place of a share: only the range that crosses it is read",
    "render_all_customers": "numbering of rows written in order: no shuffle, no sort of the rows",
    "spending_by_customer_bucketed": "customer report over the bucketed join result: no Exchange",
    "enrich_hot_product": "a product in a third of the lines: its lines alone dealt over salts",
    "accepted_lines": "text lines -> validator (projections; only the outcome passes the one-row generator) -> accepted",
    "shop_revenue_by_category": "the reference's run: parsed lines x parsed catalog -> >= 20 -> per category",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)  # a local session: a scratch folder
    out = [
        "# Physical plans",
        "",
        f"Physical plans (as planned, before adaptive re-planning) at `{sf_dir}` on local[8]; "
        "regenerate with `python scripts/dump_plans.py`.",
        "",
    ]
    for name, note in SHOWN.items():
        df = QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        # keep the operator tree; the per-node details repeat long expressions
        tree = text.split("\n\n\n")[0]
        details = [
            line
            for line in text.splitlines()
            if line.startswith(("PushedFilters", "ReadSchema", "Join type", "Arguments: HashedRelation"))
        ]
        out += [f"## {name}", "", note, "", "```", tree.strip(), "", *details, "```", ""]
    path = os.path.join(ROOT, "docs", "plans.md")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
