from pyspark.sql import functions as F

from tillroll.functions import render
from tillroll.functions.compose import Step, chain, filter_k, identity, lift, then, zip_steps
from tillroll.operators.aggregates import order_size_zero_filled
from tillroll.operators.ranking import keys_to_reach, pareto

half = lift(lambda c: c / 2)
shout = lift(lambda c: F.concat(c.cast("string"), F.lit("!")))
minus_three = lift(lambda c: c - 3)


def _eval(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def test_then_and_operator(spark):
    assert _eval(spark, then(half, shout)(F.lit(7))) == "3.5!"
    assert _eval(spark, (half >> shout)(F.lit(7))) == "3.5!"


def test_then_is_associative(spark):
    a = then(then(minus_three, half), minus_three)
    b = then(minus_three, then(half, minus_three))
    assert _eval(spark, a(F.lit(19))) == _eval(spark, b(F.lit(19))) == 5.0


def test_identity_is_neutral(spark):
    assert _eval(spark, then(identity(), minus_three)(F.lit(10))) == 7
    assert _eval(spark, then(minus_three, identity())(F.lit(10))) == 7


def test_zip(spark):
    r = _eval(spark, zip_steps(minus_three, shout)(F.lit(8)))
    assert (r["_1"], r["_2"]) == (5, "8!")


def test_filter_k(spark):
    small = filter_k(minus_three, lambda c: c < 0)
    assert _eval(spark, small(F.lit(1))) == -2
    assert _eval(spark, small(F.lit(4))) is None


def test_chain(spark):
    assert _eval(spark, chain([minus_three, half, minus_three])(F.lit(13))) == 2.0
    assert _eval(spark, chain([])(F.lit("kept"))) == "kept"


def test_steps_compose_dataframe_transforms(spark):
    df = spark.range(10)
    step = Step(lambda d: d.where("id > 2")) >> (lambda d: d.select((F.col("id") * 2).alias("id")))
    assert [r.id for r in step(df).collect()] == [6, 8, 10, 12, 14, 16, 18]


def _lines(df):
    return [r.line for r in df.orderBy("line_no").collect()]


def test_render_quality(spark):
    s = spark.createDataFrame([(99, 1, 1.0)], "accepted long, rejected long, rejected_share double")
    assert _lines(render.render_quality(s)) == ["accepted lines : 99", "rejected lines : 1  (1.00 % of the file)"]
    z = spark.createDataFrame([(0, 0, 0.0)], "accepted long, rejected long, rejected_share double")
    assert _lines(render.render_quality(z))[1] == "rejected lines : 0  (0.00 % of the file)"


def test_render_reports(spark):
    cats = spark.createDataFrame(
        [("Tea", 40.0, 3, 7), ("Maps", 150.0, 2, 4), ("Ink", 10.0, 1, 1)],
        "category string, revenue double, orders long, units_sold long",
    )
    lines = _lines(render.render_categories(cats))
    assert lines[0] == "Maps                   150.00         2 orders         4 units"
    assert [x.split()[0] for x in lines] == ["Maps", "Tea", "Ink"]
    p = _lines(render.render_pareto(pareto(cats), keys_to_reach(cats, 80.0), 80.0))
    assert p[0] == "Maps                   150.00   75.00 % cumulated"
    assert p[-2:] == ["", "FINDING: 2 categories out of 3 generate 80 % of it."]
    countries = spark.createDataFrame([("Peru", 514.0), ("Norway", 1352.0)], "country string, revenue double")
    assert _lines(render.render_countries(countries)) == ["Norway                1352.00", "Peru                   514.00"]
    customers = spark.createDataFrame([("K8", 1637.0, 2)], "customer_id string, total_spent double, orders long")
    assert _lines(render.render_customers(customers)) == ["K8                1637.00       2 orders"]
    total = spark.createDataFrame([(1866.0,)], "grand_total double")
    assert _lines(render.render_total(total)) == ["total revenue of the analysed lines : 1866.00"]


def test_render_sizes_zero_filled(spark):
    df = spark.createDataFrame([(10.0,)] * 7, "revenue double")
    lines = _lines(render.render_sizes(order_size_zero_filled(df)))
    assert lines == [
        "SMALL             7 lines  (below 50.0 dollars)",
        "MEDIUM            0 lines  (between 50.0 and 200.0)",
        "LARGE             0 lines  (between 200.0 and 1000.0)",
        "PREMIUM           0 lines  (at least 1000.0 dollars)",
    ]


def test_rendered_order(spark):
    rows = [(f"C{i:03d}", float((i * 37) % 11), i % 5) for i in range(60)]
    report = spark.createDataFrame(rows, "customer_id string, total_spent double, orders long")
    expected = [c for c, _, _ in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert [x.split()[0] for x in _lines(render.render_customers(report))] == expected
