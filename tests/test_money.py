import math

from pyspark.sql import functions as F

from tillroll.functions.money import money_sum, revenue_of, round_money


def _round(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return [r[0] for r in df.select(round_money("x")).collect()]


def _java_round_money(x: float) -> float:
    """Math.round(x * 100) / 100 as the JVM computes it (floor of x + 1/2, exact)."""
    s = x * 100.0
    if math.isnan(s):
        return 0.0
    if math.isinf(s):
        return (2**63 - 1 if s > 0 else -(2**63)) / 100.0
    low = math.floor(s)
    return (low + (1 if s - low >= 0.5 else 0)) / 100.0


def test_round_money_examples(spark):
    assert _round(spark, [1.006, 1.0049, 1.005]) == [1.01, 1.0, 1.0]


def test_round_money_is_not_half_up_on_decimal_text(spark):
    # F.round works on the decimal text and rounds 1.005 up; the JVM rule does not
    got = spark.range(1).select(F.round(F.lit(1.005), 2), round_money(F.lit(1.005))).first()
    assert got[0] == 1.01 and got[1] == 1.0


def test_round_money_special_values(spark):
    got = _round(spark, [float("nan"), float("inf"), float("-inf"), -2.5, -0.005, 0.0])
    assert got[0] == 0.0
    assert got[1] == 9.223372036854776e16
    assert got[2] == -9.223372036854776e16
    assert got[3] == -2.5
    assert got[4] == _java_round_money(-0.005)
    assert got[5] == 0.0


def test_round_money_matches_jvm_rule_on_many_values(spark):
    import random

    rnd = random.Random(7)
    values = [rnd.uniform(-1e6, 1e6) for _ in range(2000)] + [k / 1000.0 for k in range(-2000, 2000)]
    # one ulp below a tie: floor(s + 0.5) would round up, Math.round does not
    values.append(0.49999999999999994 / 100.0)
    got = _round(spark, values)
    assert got == [_java_round_money(v) for v in values]


def test_revenue_of(spark):
    df = spark.createDataFrame([(3, 19.90)], "q int, p double")
    assert df.select(revenue_of("q", "p")).first()[0] == 59.70


def test_money_sum_is_exact_and_empty_is_null(spark):
    df = spark.createDataFrame([(1.0,)] * 200_000, "revenue double").repartition(13)
    assert df.agg(money_sum("revenue")).first()[0] == 200000.0
    df2 = spark.createDataFrame([(0.1,)] * 10 + [(0.2,)] * 10, "revenue double")
    assert df2.agg(money_sum("revenue")).first()[0] == 3.0
    empty = df.where("revenue < 0")
    assert empty.agg(money_sum("revenue")).first()[0] is None


def test_money_sum_of_extreme_prices(spark):
    def total(values):
        return spark.createDataFrame([(v,) for v in values], "x double").agg(money_sum("x"), money_sum(F.col("x"))).first()

    top = 9.223372036854776e16
    for values, expected in [
        ([top, 1.0], top), ([float("inf"), 1.0], top), ([float("-inf"), 1.0], -top), ([9e15] * 10, 9e16),
        ([9e15] * 20, top), ([0.004] * 1000, 4.0), ([0.004], 0.0), ([float("nan"), 1.0], 0.0), ([None, 2.5], 2.5),
    ]:
        assert list(total(values)) == [expected, expected], values
