import pytest

from tillroll.sources.lines import (
    PRODUCT_SPEC,
    TRANSACTION_SPEC,
    accepted,
    clean_lines,
    parse_lines,
    quality_summary,
    read_lines,
    rejected,
    rejects_by_kind,
)

GOOD = "X-55,buyer 9,SKU/3,12,0.75,Côte d'Ivoire,31.12.2022"


def _parse(spark, lines, spec=TRANSACTION_SPEC):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return parse_lines(df, spec).collect()


def _one(spark, line, spec=TRANSACTION_SPEC):
    return _parse(spark, [line], spec)[0]


def test_accepted_line(spark):
    r = _one(spark, GOOD)
    assert r.reason is None and r.error_kind is None
    assert (r.order_id, r.customer_id, r.product_id, r.quantity, r.unit_price, r.country, r.order_date) == (
        "X-55", "buyer 9", "SKU/3", 12, 0.75, "Côte d'Ivoire", "31.12.2022"
    )


@pytest.mark.parametrize(
    "line,kind,reason",
    [
        ("X1,b,s,12,0.75,Fiji", "WrongFieldCount", "expected 7 fields but found 6"),
        ("X1,b,s,12,cheap,Fiji,d", "NotANumber", "field unitPrice is not a number: 'cheap'"),
        ("X1,b,s,-0.5,1,Fiji,d", "OutOfRange", "field quantity is out of range: '-0.5'"),
        ("X1,\t,s,12,0.75,Fiji,d", "MissingField", "field customerId is empty"),
        ("T1,C1,P1,1,inf,X,d", "NotANumber", "field unitPrice is not a number: 'inf'"),
        ("T1,C1,P1,,10,X,d", "NotANumber", "field quantity is not a number: ''"),
        ("T1,C1,P1,0,10,X,d", "OutOfRange", "field quantity is out of range: '0'"),
        ('T1,C1,P1,1,10,"a,b",d', "WrongFieldCount", "expected 7 fields but found 8"),
        (" ", "WrongFieldCount", "expected 7 fields but found 1"),
        (",,,,,,", "MissingField", "field orderId is empty"),
        ("T1,C1,P1,1_0,10,X,d", "NotANumber", "field quantity is not a number: '1_0'"),
        ("T1,C1,P1,nan,10,X,d", "NotANumber", "field quantity is not a number: 'nan'"),
        ("T1,C1,P1,-Infinity,10,X,d", "OutOfRange", "field quantity is out of range: '-Infinity'"),
        ("T1,C1,P1,2,1,X,", "MissingField", "field orderDate is empty"),
    ],
)
def test_rejected_lines(spark, line, kind, reason):
    r = _one(spark, line)
    assert (r.error_kind, r.reason, r.line) == (kind, reason, line)
    assert r.order_id is None and r.quantity is None


@pytest.mark.parametrize(
    "line,quantity,price",
    [
        ("T1,C1,P1,3.9,10,X,d", 3, 10.0),
        ("T1,C1,P1,0.5,10,X,d", 0, 10.0),
        ("T1,C1,P1,1e12,10,X,d", 2147483647, 10.0),
        ("T1,C1,P1,NaN,10,X,d", 0, 10.0),
        ("T1,C1,P1,1,Infinity,X,d", 1, float("inf")),
        ("T1,C1,P1,1d,0x1p3,X,d", 1, 8.0),
        ("T1,C1,P1,+2,1.5f,X,d", 2, 1.5),
    ],
)
def test_lenient_numbers(spark, line, quantity, price):
    r = _one(spark, line)
    assert r.reason is None
    assert r.quantity == quantity and r.unit_price == price


def test_trim_removes_control_characters(spark):
    r = _one(spark, "\tT1 , C1,P1,1,10,X,d\x01")
    assert r.reason is None and r.order_id == "T1" and r.customer_id == "C1" and r.order_date == "d"


def test_reason_uses_trimmed_value_line_is_raw(spark):
    line = "T1,C1,P1,1, abc\t,X,d"
    r = _one(spark, line)
    assert r.reason == "field unitPrice is not a number: 'abc'" and r.line == line


def test_product_line(spark):
    r = _one(spark, "SKU/3,Brass Bell,Music,8e1", PRODUCT_SPEC)
    assert r.reason is None and (r.product_id, r.product_name, r.category, r.base_price) == (
        "SKU/3", "Brass Bell", "Music", 80.0
    )
    bad = _one(spark, "SKU/4,Bell,Music,0", PRODUCT_SPEC)
    assert bad.reason == "field basePrice is out of range: '0'"


def test_headers_and_empty_lines_are_skipped(spark):
    lines = [
        "orderId,customerId,productId,quantity,unitPrice,country,orderDate",
        "productId,productName,category,basePrice",
        "",
        "orderIdX,C1,P1,1,1,X,d",
        GOOD,
        " orderId,customerId,productId,quantity,unitPrice,country,orderDate",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    kept = [r.value for r in clean_lines(df).collect()]
    assert kept == [GOOD, " orderId,customerId,productId,quantity,unitPrice,country,orderDate"]
    # a header with a leading blank is not recognised and is refused as data
    parsed = parse_lines(clean_lines(df)).collect()
    assert parsed[1].reason == "field quantity is not a number: 'quantity'"


def test_mixed_file_partition(spark, scratch):
    path = f"{scratch}/transactions.csv"
    body = [
        "orderId,customerId,productId,quantity,unitPrice,country,orderDate",
        "X1,b1,s1,5,2.5,Fiji,d1",
        "X2,b1,s2,many,2.5,Fiji,d1",
        "",
        "X3,b2,s3",
        "X4,b2,s1,1,0.01,Peru,d2",
        "X5,b3,s1,1,-1,Peru,d2",
        "X6,b3,s1,2,9,Peru,d3",
    ]
    with open(path, "w") as fh:
        fh.write("\n".join(body) + "\n")
    parsed = parse_lines(read_lines(spark, path)).cache()
    acc = accepted(parsed).collect()
    rej = rejected(parsed).collect()
    assert sorted(r.order_id for r in acc) == ["X1", "X4", "X6"]
    assert sorted(r.line for r in rej) == ["X2,b1,s2,many,2.5,Fiji,d1", "X3,b2,s3", "X5,b3,s1,1,-1,Peru,d2"]
    q = quality_summary(parsed).first()
    assert (q.accepted, q.rejected) == (3, 3)
    assert q.accepted + q.rejected == read_lines(spark, path).count()
    kinds = {r.error_kind: r["count"] for r in rejects_by_kind(parsed).collect()}
    assert kinds == {"NotANumber": 1, "WrongFieldCount": 1, "OutOfRange": 1}


def test_quality_of_nothing(spark):
    empty = spark.createDataFrame([], "value string")
    q = quality_summary(parse_lines(empty)).first()
    assert (q.accepted, q.rejected, q.rejected_share) == (0, 0, 0.0)


def test_rejects_all_kinds_query_covers_every_kind(spark):
    from tillroll.plans.queries import q_rejects_all_kinds

    kinds = {r.error_kind for r in q_rejects_all_kinds(spark, "/root/testdata/sf0.01").select("error_kind").distinct().collect()}
    assert kinds == {None, "WrongFieldCount", "NotANumber", "OutOfRange", "MissingField"}


def test_column_validators(spark):
    from tillroll.sources.lines import jvm_double, jvm_to_int, jvm_trim

    df = spark.createDataFrame([("1d", "\t x\x01", 3.9), ("inf", "y", float("nan")), ("NaN", "", 1e12)], "n string, t string, q double")
    rows = df.select(jvm_double("n").alias("d"), jvm_trim("t").alias("t"), jvm_to_int("q").alias("i")).collect()
    assert rows[0].d == 1.0 and rows[0].t == "x" and rows[0].i == 3
    assert rows[1].d is None and rows[1].i == 0
    assert rows[2].d != rows[2].d and rows[2].t == "" and rows[2].i == 2147483647


def test_nan_price_is_accepted_and_earns_nothing(spark):
    """S7: NaN passes the > 0 check; its revenue rounds to 0.0 like Math.round."""
    from tillroll.operators.enrich import enrich

    lines = spark.createDataFrame([("T1,C1,P1,2,NaN,X,d",)], "value string")
    tx = accepted(parse_lines(lines))
    catalog = spark.createDataFrame([("P1", "Lamp", "Garden")], "product_id string, product_name string, category string")
    row = enrich(tx, catalog).first()
    assert row.unit_price != row.unit_price and row.revenue == 0.0


def test_counts_read_no_value_columns(spark):
    lines = spark.createDataFrame([(GOOD,), ("x",)], "value string")
    for report in (quality_summary(parse_lines(lines)), rejects_by_kind(parse_lines(lines))):
        plan = report._jdf.queryExecution().optimizedPlan().toString()
        assert "order_date" not in plan and "unit_price" not in plan
