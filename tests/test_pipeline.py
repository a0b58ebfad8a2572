"""The whole run on text files: six reports written, sections rendered."""

import glob
import io
import os

from tillroll.plans.pipeline import PipelineConfig, pipeline_run, print_sections, run_pipeline

PRODUCTS = [
    "productId,productName,category,basePrice",
    "A10,Oak Desk,Furniture,120.5",
    "A11,Wool Scarf,Apparel,18.25",
    "A12,Field Lens,Optics,640.0",
    "A13,Paper Kite,Play,free",
]
TRANSACTIONS = [
    "orderId,customerId,productId,quantity,unitPrice,country,orderDate",
    "L1,K7,A11,1,18.25,Peru,2023-05-02",
    "L2,K7,A10,1,120.5,Peru,2023-05-02",
    "L3,K8,A12,2,640.0,Norway,2023-05-03",
    "L4,K9,A11,4,18.0,Norway,2023-05-04",
    "L5,K8,A13,1,9.0,Peru,2023-05-04",
    "L6,K9,A10,two,119.0,Norway,2023-05-05",
    "L7,K9,A10",
    "",
]


def _write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_run_writes_six_reports(spark, scratch):
    data = os.path.join(scratch, "data")
    out = os.path.join(scratch, "output")
    os.makedirs(data)
    _write(f"{data}/products.csv", PRODUCTS)
    _write(f"{data}/transactions.csv", TRANSACTIONS)
    config = PipelineConfig(data_dir=data, output_dir=out, minimal_revenue=20.0)
    run = run_pipeline(spark, config)
    try:
        buf = io.StringIO()
        print_sections(run, buf)
        text = buf.getvalue()
    finally:
        run.close()
    for name in ("revenue_by_category", "revenue_by_country", "top_customers", "order_sizes", "pareto_categories", "rejected_lines"):
        assert os.path.exists(f"{out}/{name}/_SUCCESS"), name
    cat_files = glob.glob(f"{out}/revenue_by_category/*.csv")
    assert len(cat_files) == 1
    cats = open(cat_files[0]).read().splitlines()
    assert cats[0] == "category,revenue,orders,units_sold"
    assert sorted(cats[1:]) == ["Apparel,72.0,1,4", "Furniture,120.5,1,1", "Optics,1280.0,1,2"]
    rejected = "".join(open(f).read() for f in glob.glob(f"{out}/rejected_lines/*.csv"))
    assert "field quantity is not a number: 'two',\"L6,K9,A10,two,119.0,Norway,2023-05-05\"" in rejected
    assert "accepted lines : 5" in text
    assert "rejected lines : 2  (28.57 % of the file)" in text
    assert "FINDING: 1 categories out of 3 generate 80 % of it." in text
    assert "total revenue of the analysed lines : 1472.50" in text
    assert "LARGE             0 lines  (between 200.0 and 1000.0)" in text


def test_line_frames_override_files(spark):
    tx = spark.createDataFrame([(x,) for x in TRANSACTIONS], "value string")
    pr = spark.createDataFrame([(x,) for x in PRODUCTS], "value string")
    with pipeline_run(spark, PipelineConfig(), transaction_lines=tx, product_lines=pr) as run:
        sizes = {r["size"]: r["count"] for r in run.reports["order_sizes"].collect()}
        assert sizes == {"SMALL": 1, "MEDIUM": 2, "LARGE": 0, "PREMIUM": 1}
        top = run.reports["top_customers"].collect()
        assert [(r.customer_id, r.total_spent) for r in top] == [("K8", 1280.0), ("K7", 120.5), ("K9", 72.0)]


def test_checkpoint_materialization_and_rejected_products(spark):
    tx = spark.createDataFrame([(x,) for x in TRANSACTIONS], "value string")
    pr = spark.createDataFrame([(x,) for x in PRODUCTS], "value string")
    config = PipelineConfig(materialize="checkpoint")
    with pipeline_run(spark, config, transaction_lines=tx, product_lines=pr) as run:
        cats = {r.category: r.revenue for r in run.categories.collect()}
        assert cats == {"Apparel": 72.0, "Furniture": 120.5, "Optics": 1280.0}
        assert [r.reason for r in run.rejected_products.collect()] == ["field basePrice is not a number: 'free'"]
        assert run.persisted == []


def test_write_report_file_layouts(spark, scratch):
    from tillroll.sources.sinks import write_report

    df = spark.range(0, 1000, 1, 4).selectExpr("id", "id % 7 AS k")
    agg = df.groupBy("k").count()
    write_report(agg, f"{scratch}/agg")
    write_report(df, f"{scratch}/rows_one", row_level=True)
    write_report(df, f"{scratch}/rows_many", single_file=False)
    assert len(glob.glob(f"{scratch}/agg/*.csv")) == 1
    assert len(glob.glob(f"{scratch}/rows_one/*.csv")) == 1
    assert len(glob.glob(f"{scratch}/rows_many/*.csv")) == 4
    back = spark.read.option("header", True).csv(f"{scratch}/rows_one")
    assert back.count() == 1000 and back.columns == ["id", "k"]


def test_single_pass_reports_equal_separate(spark):
    tx = spark.createDataFrame([(x,) for x in TRANSACTIONS], "value string")
    pr = spark.createDataFrame([(x,) for x in PRODUCTS], "value string")

    def reports(single):
        with pipeline_run(spark, PipelineConfig(single_pass_reports=single), transaction_lines=tx, product_lines=pr) as run:
            return {name: sorted(tuple(r) for r in run.report(name).collect()) for name in run.REPORTS} | {
                "columns": [run.report(n).columns for n in run.REPORTS]
            }

    assert reports(True) == reports(False)


def test_failed_write_releases_the_cache(spark, scratch, monkeypatch):
    from tillroll.plans import pipeline

    data = os.path.join(scratch, "data")
    os.makedirs(data)
    _write(f"{data}/products.csv", PRODUCTS)
    _write(f"{data}/transactions.csv", TRANSACTIONS)
    closed = []
    monkeypatch.setattr(pipeline.PipelineRun, "close", lambda self: closed.append(self))

    def broken(*args, **kwargs):
        raise OSError("disk full")

    monkeypatch.setattr(pipeline, "write_report", broken)
    try:
        run_pipeline(spark, PipelineConfig(data_dir=data, output_dir=f"{scratch}/out"))
    except OSError:
        pass
    assert len(closed) == 1
