"""The run on files: one scan of the text, counts on the way, buckets, and reports that
appear together."""

import glob
import json
import os
import uuid

import pytest
from pyspark.sql import functions as F
from test_pipeline import PRODUCTS, TRANSACTIONS

from tillroll.operators.ordered import Ordered
from tillroll.plans import pipeline
from tillroll.plans.pipeline import PipelineConfig, pipeline_run, run_pipeline
from tillroll.sources import sinks
from tillroll.sources.lines import TRANSACTION_SPEC, Outcomes, accepted, clean_lines, parse_lines, quality_summary, rejected


def frames(spark):
    return {"transaction_lines": spark.createDataFrame([(x,) for x in TRANSACTIONS], "value string"),
            "product_lines": spark.createDataFrame([(x,) for x in PRODUCTS], "value string")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_outcomes_equal_the_lazy_split(spark, scratch):
    parsed = parse_lines(clean_lines(frames(spark)["transaction_lines"]), TRANSACTION_SPEC)
    out = Outcomes(parsed, f"{scratch}/o")
    assert rows(out.accepted) == rows(accepted(parsed)) and out.accepted.columns == accepted(parsed).columns
    assert rows(out.rejected) == rows(rejected(parsed))
    assert out.summary.first() == quality_summary(parsed).first()
    assert sorted(os.path.basename(p) for p in glob.glob(f"{scratch}/o/_outcome=*")) == ["_outcome=accepted", "_outcome=rejected"]
    for n, odd in enumerate((parsed.limit(0), parsed.where("reason IS NULL"))):
        some = Outcomes(odd, f"{scratch}/o{n}")
        assert rows(some.accepted) == rows(accepted(odd)) and some.rejected.count() == 0
        assert some.summary.first() == quality_summary(odd).first()


def jobs_and_text_reads(spark, action):
    """(jobs started, rows that text scans read) while ``action`` runs."""
    sc = spark.sparkContext
    seen = sc.accumulator(0)
    group = f"counted-{uuid.uuid4().hex}"
    sc.setJobGroup(group, group)
    try:
        action(seen)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group)), seen.value


def counting(lines, seen):
    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return lines.mapInArrow(run, "value string")


def test_text_is_scanned_once_and_counts_need_no_job(spark):
    own = frames(spark)
    def use(mode):
        def action(seen):
            config = PipelineConfig(materialize=mode)
            with pipeline_run(spark, config, transaction_lines=counting(own["transaction_lines"], seen), product_lines=own["product_lines"]) as run:
                out[mode] = {name: rows(df) for name, df in run.reports.items()}
                out[mode]["texts"] = {name: rows(df) for name, df in run.texts.items()}
        return action

    out = {}
    _, read = jobs_and_text_reads(spark, use("files"))
    assert read == len(TRANSACTIONS)  # every line once
    jobs_and_text_reads(spark, use("cache"))
    assert out["files"] == out["cache"]

    with pipeline_run(spark, PipelineConfig(materialize="files"), **own) as run:
        run.outcomes
        jobs, _ = jobs_and_text_reads(spark, lambda seen: run.quality)
        assert jobs == 0 and run.quality.first().accepted == 5
        plan = run.quality._jdf.queryExecution().executedPlan().toString()
        assert "FileScan" not in plan and "Exchange" not in plan


def test_customer_report_needs_no_exchange(spark):
    with pipeline_run(spark, PipelineConfig(materialize="files"), **frames(spark)) as run:
        spent = run._grouped[2]
        plan = spent._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert {r.customer_id: r.total_spent for r in spent.collect()} == {"K7": 120.5, "K8": 1280.0, "K9": 72.0}
        tables, folders = list(run.tables), list(run.folders)
    assert not any(spark.catalog.tableExists(t) for t in tables)
    assert folders and not any(os.path.exists(f.removeprefix("file:")) for f in folders)


def written_run(spark, scratch, minimal=20.0):
    data, out = f"{scratch}/data", f"{scratch}/output"
    os.makedirs(data, exist_ok=True)
    for name, lines in (("products", PRODUCTS), ("transactions", TRANSACTIONS)):
        with open(f"{data}/{name}.csv", "w") as f:
            f.write("\n".join(lines) + "\n")
    run_pipeline(spark, PipelineConfig(data_dir=data, output_dir=out, minimal_revenue=minimal)).close()
    return out


def contents(out):
    return {p.removeprefix(out): open(p).read() for p in sorted(glob.glob(f"{out}/*/*.csv"))}


def test_a_failed_sixth_report_leaves_the_old_run(spark, scratch, monkeypatch):
    out = written_run(spark, scratch)
    before = contents(out)
    assert len({p.split("/")[1] for p in before}) == 6
    real, calls = pipeline.write_report, []

    def sixth_fails(df, path, **kw):
        calls.append(path)
        if len(calls) == 6:
            raise RuntimeError("disk full")
        real(df, path, **kw)

    monkeypatch.setattr(pipeline, "write_report", sixth_fails)
    with pytest.raises(RuntimeError):
        written_run(spark, scratch, minimal=100.0)
    assert contents(out) == before and len(calls) == 6
    monkeypatch.undo()
    written_run(spark, scratch, minimal=100.0)
    after = contents(out)
    assert set(after) != set(before) and not os.path.exists(f"{out}/_staging")
    assert "Apparel" not in "".join(t for p, t in after.items() if "category" in p)


def test_a_driver_lost_during_the_exchange(spark, scratch, monkeypatch):
    """Whatever step the exchange of a committed run stops at, the next call completes it;
    a run that was not committed goes."""
    def report(n):
        return spark.range(n).selectExpr("id")

    folders = {"a": "a", "b": "b", "c": "c"}
    for stop in range(1, 7):
        out = f"{scratch}/out{stop}"
        sinks.write_reports(spark, {k: report(1) for k in folders}, folders, out)
        real, steps = sinks.finish_run, []

        class Stopping:
            def __init__(self, fs):
                self.fs = fs

            def __getattr__(self, name):
                if name == "rename":
                    steps.append(1)
                    if len(steps) > stop:
                        raise KeyboardInterrupt
                return getattr(self.fs, name)

        whole = sinks.file_system
        monkeypatch.setattr(sinks, "file_system", lambda s, p: (Stopping(whole(s, p)[0]), whole(s, p)[1]))
        try:
            sinks.write_reports(spark, {k: report(2) for k in folders}, folders, out)
        except KeyboardInterrupt:
            pass
        monkeypatch.undo()
        real(spark, out)
        assert [spark.read.option("header", True).csv(f"{out}/{k}").count() for k in folders] == [2, 2, 2], stop
        assert not os.path.exists(f"{out}/_staging")
    out = f"{scratch}/uncommitted"
    sinks.write_reports(spark, {"a": report(1)}, folders, out)
    os.makedirs(f"{out}/_staging/left/new/a")
    assert sinks.finish_run(spark, out) == 0 and not os.path.exists(f"{out}/_staging")
    assert spark.read.option("header", True).csv(f"{out}/a").count() == 1


def test_ordered_files_of_bounded_size(spark, scratch):
    df = spark.range(1000).selectExpr("id AS key", "CAST(pmod(xxhash64(id), 50) AS DOUBLE) AS amount")
    with Ordered.of(df, "amount", "key", ranges=4) as o:
        sinks.write_report(o, f"{scratch}/ordered", max_rows_per_file=100)
    files = sorted(glob.glob(f"{scratch}/ordered/*.csv"))
    lines = [open(f).read().splitlines() for f in files]
    assert len(files) >= 10 and all(x[0] == "key,amount" and len(x) <= 101 for x in lines)
    got = [(int(k), float(a)) for x in lines for k, a in (line.split(",") for line in x[1:])]
    assert got == sorted(((r.key, r.amount) for r in df.collect()), key=lambda r: (-r[1], r[0]))
    assert os.path.exists(f"{scratch}/ordered/_SUCCESS") and json.dumps(len(got)) == "1000"
    assert spark.read.option("header", True).csv(f"{scratch}/ordered").agg(F.count("*")).first()[0] == 1000
