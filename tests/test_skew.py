"""Joins with a hot product and with lines that the catalog does not know."""

import pytest
from pyspark.sql import functions as F

from tillroll.operators.enrich import enrich
from tillroll.operators.skew import hot_keys, key_filter, only_known


@pytest.fixture
def raw_partitions(spark):
    """Partitions as the shuffle deals them: no merging and no splitting after it."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def crowded(spark, n=60000):
    return spark.range(n).selectExpr(
        "IF(id % 3 = 0, 7, 100 + id % 5000) AS product_id", "id AS order_id", "1 AS quantity", "CAST(id % 97 AS DOUBLE) AS unit_price"
    ).repartition(6)


def catalog(spark):
    return spark.range(6000).selectExpr("CAST(id AS BIGINT) AS product_id", "concat('n', id) AS product_name", "concat('c', id % 9) AS category")


def sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_hot_keys(spark):
    assert hot_keys(crowded(spark), "product_id", 8).first().keys == [7]
    even = spark.range(10000).selectExpr("id % 1000 AS k")
    assert hot_keys(even, "k", 8).first().keys == []
    assert hot_keys(even.limit(0), "k", 8).first().keys in ([], None)
    nulls = spark.range(100).selectExpr("IF(id < 90, NULL, id) AS k")
    assert None not in hot_keys(nulls, "k", 8).first().keys


def test_no_task_above_twice_the_median(spark, raw_partitions):
    lines, cat = crowded(spark), catalog(spark)
    plain = sizes(enrich(lines, cat, join_hint="merge"))
    spread = sizes(enrich(lines, cat, join_hint="merge", spread_hot=True))
    assert sum(plain) == sum(spread) == 60000
    assert plain[-1] > 3 * plain[len(plain) // 2]
    assert len(spread) == 8 and spread[-1] < 2 * spread[len(spread) // 2]


def test_results_are_those_of_the_plain_join(spark):
    odd = spark.createDataFrame([(None, 1, 1, 2.0), (7, 2, 1, 3.0), (7, 2, 1, 3.0), (999999, 3, 1, 1.0)],
                                "product_id long, order_id long, quantity int, unit_price double")
    twice = catalog(spark).union(catalog(spark).where("product_id IN (7, 101)"))  # fans out
    lines = crowded(spark, 3000).union(odd).withColumn("_hot", F.lit("clash")).withColumn("words", F.lit(1))
    want = sorted(map(tuple, enrich(lines, twice).collect()))
    for kw in ({"spread_hot": True}, {"prefilter": True}, {"spread_hot": True, "prefilter": True, "join_hint": "merge"}):
        got = enrich(lines, twice, **kw)
        assert sorted(map(tuple, got.collect())) == want, kw
        assert got.columns == enrich(lines, twice).columns
    for a, b in ((lines.limit(0), twice), (lines, twice.limit(0))):
        assert enrich(a, b, spread_hot=True, prefilter=True).count() == 0


@pytest.mark.parametrize("kind", ["string", "int", "double", "date"])
def test_filter_keeps_every_known_key(spark, kind):
    cast = {"date": "date_add(DATE'2000-01-01', CAST(id AS INT))"}.get(kind, f"CAST(id AS {kind})")
    known = spark.range(0, 4000, 2).selectExpr(f"{cast} AS k").union(spark.createDataFrame([(None,)], f"k {kind}"))
    lines = spark.range(4000).selectExpr("id", f"{cast} AS k")
    kept = {r.id for r in only_known(lines, known, "k").collect()}
    assert set(range(0, 4000, 2)) <= kept
    assert len(kept) - 2000 < 0.05 * 2000  # few unknown ones pass


def test_filter_key_types(spark):
    mixed = spark.range(10).selectExpr("CAST(id AS INT) AS k")
    assert only_known(mixed, spark.range(5).withColumnRenamed("id", "k"), "k").where("k < 5").count() == 5
    with pytest.raises(ValueError):
        only_known(mixed, spark.range(5).selectExpr("CAST(id AS STRING) AS k"), "k")
    zero = spark.createDataFrame([(-0.0,)], "k double")
    assert only_known(zero, spark.createDataFrame([(0.0,)], "k double"), "k").count() == 1
    assert len(key_filter(mixed, "k").first().words) == 64
    assert set(key_filter(mixed.limit(0), "k").first().words) == {0}


def test_unmatched_lines_do_not_cross_the_exchange(spark, scratch, raw_partitions):
    """Rows written by the lines' side of the shuffle, from the executed plan."""
    catalog(spark).write.parquet(f"{scratch}/c")
    spark.range(40000).selectExpr("IF(id % 2 = 0, id % 6000, 50000 + id) AS product_id", "id AS order_id", "1 AS quantity",
                                  "1D AS unit_price").write.parquet(f"{scratch}/l")
    lines, cat = spark.read.parquet(f"{scratch}/l"), spark.read.parquet(f"{scratch}/c")
    joined = enrich(lines, cat, join_hint="merge", prefilter=True)
    assert joined.count() == 20000
    text = joined._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("getbit"):]  # the filter stands on the scan, below the exchange
    assert "FileScan" in below.split("Exchange", 1)[0]
    kept = only_known(lines, cat, "product_id").count()
    assert 20000 <= kept < 20600
