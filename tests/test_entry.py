"""The driver contract: entry(), queries() and oracle_sql() line up."""

import duckdb

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def own_queries():
    from tillroll.plans.queries import QUERIES

    return {name: q for name, q in contract.queries().items() if name in QUERIES}


def test_every_query_has_an_oracle():
    assert set(own_queries()) <= set(contract.oracle_sql())
    assert len(own_queries()) >= 40


def test_entry_schema(spark):
    df = contract.entry(spark)
    assert df.columns == ["category", "revenue", "cumulative_share"]
    rows = df.collect()
    assert rows and max(r.cumulative_share for r in rows) == 100.0


def test_queries_and_oracles_agree_on_shape_at_smallest_scale(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    oracle = contract.oracle_sql()
    for name, query in own_queries().items():
        df = query(spark, SF)
        res = con.execute(oracle[name])
        cols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(cols), name
        assert df.count() == len(res.fetchall()), name


def test_entry_without_the_corpus_operators():
    """The other queries register where the optional subpackage is missing."""
    import subprocess
    import sys

    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['tillroll.llm'] = None\n"
        "import __spark_entry__ as e; print(len(e.queries()), any(n.startswith('op') for n in e.queries()))"
    )
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=contract.__file__.rsplit("/", 1)[0])
    assert out.stdout.split() == [str(len(own_queries())), "False"], out.stderr


def test_appended_rows_are_seen(spark, scratch):
    from tillroll.sources.tables import table

    spark.range(5).write.parquet(f"{scratch}/t.parquet")
    assert table(spark, scratch, "t").count() == 5
    spark.range(4).write.mode("append").parquet(f"{scratch}/t.parquet")
    assert table(spark, scratch, "t").count() == 9


def test_declaring_queries_starts_only_schema_reads(spark):
    eager = {"six_report_row_counts", "text_files_run"}  # they write what several reports share
    eager |= {"pareto_by_customer_ordered", "customers_up_to_80_prefix", "top_half_of_customers", "render_all_customers"}
    eager |= {"accepted_lines_on_files", "rejected_lines_on_files", "quality_summary_observed", "spending_by_customer_bucketed"}
    sc = spark.sparkContext
    for name, query in own_queries().items():
        if name in eager:
            continue
        sc.setJobGroup(f"declare-{name}", name)
        df = query(spark, SF)
        jobs = sc.statusTracker().getJobIdsForGroup(f"declare-{name}")
        assert len(jobs) <= 12, name
        for j in jobs:
            info = sc.statusTracker().getJobInfo(j)
            assert len(info.stageIds) == 1, name  # footer reads have one stage
        assert df.columns
    sc.setLocalProperty("spark.jobGroup.id", None)
