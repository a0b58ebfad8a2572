"""The whole six-report run as one function over a config.

Parse once (both sides of the accept/reject split read one persisted parse),
join once (persisted, like the reference's cached join result), compute each
report once, then optionally write each report.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions import render
from tillroll.functions.sizes import DEFAULT_LIMITS
from tillroll.operators.aggregates import (
    grand_total_of_report,
    grouped_revenue_reports,
    split_grouped_reports,
    order_size_zero_filled,
    revenue_by_category,
    revenue_by_country,
    spending_by_customer,
)
from tillroll.operators.enrich import enrich, keep_significant
from tillroll.operators.ranking import keys_to_reach, pareto, top_by, top_customers
from tillroll.sources.lines import (
    PRODUCT_SPEC,
    TRANSACTION_SPEC,
    Outcomes,
    accepted,
    clean_lines,
    parse_lines,
    quality_summary,
    read_lines,
    rejected,
)
from tillroll.sources.sinks import write_report, write_reports
from tillroll.session import checkpoint_dir, drop_folder, shared_folder, shuffle_partitions, written

# Fixed default run parameters, equal to the reference's defaults.
DEFAULT_MINIMAL_REVENUE = 20.0
DEFAULT_TOP_CUSTOMERS = 20
DEFAULT_PARETO_THRESHOLD = 80.0

# Report directory names (fixed values).
REPORT_DIRS = {
    "revenue_by_category": "revenue_by_category",
    "revenue_by_country": "revenue_by_country",
    "top_customers": "top_customers",
    "order_sizes": "order_sizes",
    "pareto_categories": "pareto_categories",
    "rejected_lines": "rejected_lines",
}


@dataclass(frozen=True)
class PipelineConfig:
    data_dir: str = "data"
    output_dir: str = "output"
    minimal_revenue: float = DEFAULT_MINIMAL_REVENUE
    top_customer_count: int = DEFAULT_TOP_CUSTOMERS
    pareto_threshold: float = DEFAULT_PARETO_THRESHOLD
    limits: tuple[float, ...] = field(default=DEFAULT_LIMITS)
    # rejected lines are row-level output: one file per task unless asked otherwise
    single_file_rejects: bool = False
    # how the parse and the join result, each read by several reports, are kept:
    # "cache" = persist(MEMORY_AND_DISK) (lost blocks are recomputed from
    # lineage); "checkpoint" = written once to spark.checkpoint.dir, cutting the
    # lineage (for inputs too large to cache, survives executor loss);
    # "files" = the parse written to the shared folder parted by outcome (one scan of
    # the text; counts observed on the way) and the join result written bucketed by
    # customer (the customer report needs no shuffle), dropped by close();
    # "none" = every report recomputes from the files
    materialize: str = "cache"
    # compute the category, country and customer aggregates in one grouping-sets
    # pass over the significant lines (materialized like the parse); False: three
    # separate aggregations, for a caller that wants one report only
    single_pass_reports: bool = True
    # categories, countries and the top list are short by construction (a catalog's
    # categories, countries, top_customer_count rows): ordered by one window each;
    # False: range by range, for a catalog with very many categories
    short_reports: bool = True

    @property
    def transactions_path(self) -> str:
        return f"{self.data_dir}/transactions.csv"

    @property
    def products_path(self) -> str:
        return f"{self.data_dir}/products.csv"

    def report_path(self, name: str) -> str:
        return f"{self.output_dir}/{REPORT_DIRS[name]}"


class PipelineRun:
    """The frames of one run, declared lazily: only what a caller touches is
    built. The parse and the join result are persisted when first declared and
    released by :meth:`close`."""

    REPORTS = tuple(REPORT_DIRS)
    TEXTS = ("quality", "categories", "countries", "customers", "sizes", "pareto", "total")

    def __init__(
        self,
        spark: SparkSession,
        config: PipelineConfig,
        tx_lines: DataFrame,
        pr_lines: DataFrame,
        cache: bool = True,
    ):
        self.spark = spark
        self.cache = cache
        self.config = config
        self.tx_lines = tx_lines
        self.pr_lines = pr_lines
        self.persisted: list[DataFrame] = []
        self.folders: list[str] = []
        self.tables: list[str] = []

    @property
    def _on_files(self) -> bool:
        return self.cache and self.config.materialize == "files"

    def _persist(self, df: DataFrame) -> DataFrame:
        mode = self.config.materialize if self.cache else "none"
        if mode == "none":
            return df
        if mode == "files":
            self.folders.append(shared_folder(self.spark, "run"))
            return written(df, self.folders[-1])
        if mode == "checkpoint":
            if checkpoint_dir(self.spark) is None:
                raise RuntimeError("materialize='checkpoint' needs spark.checkpoint.dir (a shared folder)")
            return df.checkpoint(eager=True)
        if mode != "cache":
            raise ValueError(f"unknown materialize mode {mode!r}")
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
        self.persisted.append(df)
        return df

    def close(self) -> None:
        for df in self.persisted:
            df.unpersist()
        self.persisted.clear()
        for name in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for folder in self.folders:
            drop_folder(self.spark, folder)
        self.tables.clear()
        self.folders.clear()

    # --- inputs ---------------------------------------------------------------
    @cached_property
    def parsed(self) -> DataFrame:
        """One parse feeds both sides of the accept/reject split."""
        return self._persist(parse_lines(self.tx_lines, TRANSACTION_SPEC))

    @cached_property
    def outcomes(self) -> Outcomes:
        """The parse on files, parted by outcome (``materialize="files"``)."""
        self.folders.append(shared_folder(self.spark, "outcomes"))
        return Outcomes(parse_lines(self.tx_lines, TRANSACTION_SPEC), self.folders[-1])

    @cached_property
    def products(self) -> DataFrame:
        return accepted(parse_lines(self.pr_lines, PRODUCT_SPEC), PRODUCT_SPEC)

    @cached_property
    def rejected_products(self) -> DataFrame:
        """Refused catalog lines (the reference drops them silently)."""
        return rejected(parse_lines(self.pr_lines, PRODUCT_SPEC))

    @cached_property
    def enriched(self) -> DataFrame:
        lines = self.outcomes.accepted if self._on_files else accepted(self.parsed, TRANSACTION_SPEC)
        joined = enrich(lines, self.products, "product_id")
        if not self._on_files:
            return self._persist(joined)
        folder, name = shared_folder(self.spark, "enriched"), f"enriched_{uuid.uuid4().hex}"
        self.folders.append(folder)
        self.tables.append(name)
        return bucketed(joined, "customer_id", folder, name)

    @cached_property
    def significant(self) -> DataFrame:
        return keep_significant(self.enriched, self.config.minimal_revenue)

    @property
    def _method(self) -> str:
        return "window" if self.config.short_reports else "ranged"

    def _pareto_text(self) -> DataFrame:
        if self.config.short_reports:
            return render.render_short_pareto(self.categories, self.config.pareto_threshold)
        return render.render_pareto(self.pareto, self.reach, self.config.pareto_threshold)

    # --- the six reports --------------------------------------------------------
    @cached_property
    def _grouped(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        if self._on_files:  # the customer report keeps the buckets of the join result
            return (revenue_by_category(self.significant), revenue_by_country(self.significant),
                    spending_by_customer(self.significant))
        grouped = self._persist(grouped_revenue_reports(self.significant))
        return split_grouped_reports(grouped)

    @cached_property
    def categories(self) -> DataFrame:
        if self.config.single_pass_reports:
            return self._grouped[0]
        return revenue_by_category(self.significant)

    @cached_property
    def countries(self) -> DataFrame:
        if self.config.single_pass_reports:
            return self._grouped[1]
        return revenue_by_country(self.significant)

    @cached_property
    def customers(self) -> DataFrame:
        if self.config.single_pass_reports:
            return top_by(self._grouped[2], self.config.top_customer_count, "total_spent", "customer_id")
        return top_customers(self.significant, self.config.top_customer_count)

    @cached_property
    def sizes(self) -> DataFrame:
        return order_size_zero_filled(self.enriched, limits=self.config.limits)

    @cached_property
    def pareto(self) -> DataFrame:
        return pareto(self.categories, "category", "revenue", method=self._method)

    @cached_property
    def reach(self) -> DataFrame:
        return keys_to_reach(self.categories, self.config.pareto_threshold, "category", "revenue", method=self._method)

    @cached_property
    def rejected(self) -> DataFrame:
        return self.outcomes.rejected if self._on_files else rejected(self.parsed)

    @cached_property
    def quality(self) -> DataFrame:
        return self.outcomes.summary if self._on_files else quality_summary(self.parsed)

    def report(self, name: str) -> DataFrame:
        return {
            "revenue_by_category": lambda: self.categories,
            "revenue_by_country": lambda: self.countries,
            "top_customers": lambda: self.customers,
            "order_sizes": lambda: self.sizes.select("size", "count"),
            "pareto_categories": lambda: self.pareto,
            "rejected_lines": lambda: self.rejected,
        }[name]()

    def text(self, name: str) -> DataFrame:
        return {
            "quality": lambda: render.render_quality(self.quality),
            "categories": lambda: render.render_categories(self.categories, method=self._method),
            "countries": lambda: render.render_countries(self.countries, method=self._method),
            "customers": lambda: render.render_customers(self.customers, method="window"),
            "sizes": lambda: render.render_sizes(self.sizes),
            "pareto": self._pareto_text,
            "total": lambda: render.render_total(grand_total_of_report(self.categories)),
        }[name]()

    @property
    def reports(self) -> dict[str, DataFrame]:
        return {name: self.report(name) for name in self.REPORTS}

    @property
    def texts(self) -> dict[str, DataFrame]:
        return {name: self.text(name) for name in self.TEXTS}


def bucketed(df: DataFrame, key: str, folder: str, name: str) -> DataFrame:
    """``df`` as the table ``name``, its files in ``folder``, bucketed by ``key`` into as many
    buckets as the session's shuffle partitions: dealt once here, so grouping by or
    joining on ``key`` later needs no exchange."""
    spark = df.sparkSession
    buckets = shuffle_partitions(spark)
    # one task a bucket, so one file a bucket; a hot key is one bucket, as for any grouping
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", folder).saveAsTable(name)
    return spark.table(name)


def build_run(
    spark: SparkSession,
    config: PipelineConfig,
    *,
    transaction_lines: DataFrame | None = None,
    product_lines: DataFrame | None = None,
    cache: bool = True,
) -> PipelineRun:
    """Declare a run (lazy); line frames override the file paths.

    ``cache=False`` declares single-consumer plans (nothing persisted), for
    callers that take one report and cannot release a cache afterwards.
    """
    tx_lines = read_lines(spark, config.transactions_path) if transaction_lines is None else clean_lines(transaction_lines)
    pr_lines = read_lines(spark, config.products_path) if product_lines is None else clean_lines(product_lines)
    return PipelineRun(spark, config, tx_lines, pr_lines, cache)


@contextmanager
def pipeline_run(spark: SparkSession, config: PipelineConfig, **lines: DataFrame) -> Iterator[PipelineRun]:
    """``with pipeline_run(...) as run:`` releases the persisted frames at the end."""
    run = build_run(spark, config, **lines)
    try:
        yield run
    finally:
        run.close()


def run_pipeline(spark: SparkSession, config: PipelineConfig, *, write: bool = True) -> PipelineRun:
    """Declare the run and write the six reports, which appear together or not at all;
    returns the run for rendering.

    The caller closes the run (or uses :func:`pipeline_run`) to release the cache; a
    failed write releases it here.
    """
    run = build_run(spark, config)
    if not write:
        return run
    try:
        rejects = {"row_level": True, "single_file": config.single_file_rejects}
        write_reports(spark, run.reports, REPORT_DIRS, config.output_dir, write_report, rejected_lines=rejects)
    except BaseException:
        run.close()
        raise
    return run


def print_sections(run: PipelineRun, out=None) -> None:
    """Print the rendered sections, streaming rows partition by partition."""
    import sys

    out = out or sys.stdout
    for name, text in run.texts.items():
        print(f"\n{name.upper()}", file=out)
        for row in text.orderBy("line_no").toLocalIterator():
            print(row["line"], file=out)


def report_row_counts(run: PipelineRun) -> DataFrame:
    """``report, n_rows`` for each of the six reports (one small union of counts)."""
    frames = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("report"), "n_rows")
        for name, df in run.reports.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
