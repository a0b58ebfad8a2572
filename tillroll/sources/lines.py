"""Text-line ingest: read, drop headers, validate-or-reject every line.

One projection turns each raw line into value columns plus ``error_kind`` and
``reason`` (both NULL when the line is accepted). Accepted and rejected rows are
two filters over that single parse, so a run parses each file once.

Rules (all native column expressions, no Python per row):

* a line is split on every comma, trailing empty fields kept, no quoting;
* each field is trimmed of every character <= U+0020 at both ends;
* wrong field count wins first, then the fields are checked in order and the
  first failing check gives the reason;
* text fields must be non-empty; number fields must parse as a JVM double
  (``NaN``/``Infinity`` spelled exactly, ``1d``, ``0x1p3`` ... accepted) and be
  ``> 0`` (NaN passes, as ``NaN <= 0`` is false);
* integer fields are parsed as doubles and truncated toward zero with JVM
  saturation (NaN -> 0, above 2**31-1 -> 2147483647).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.text import sql_text as _sql_text

# Fixed values that must equal the reference's (header prefixes, field names as
# they appear in reasons, field order and kinds):
TRANSACTION_HEADER_PREFIX = "orderId"
PRODUCT_HEADER_PREFIX = "productId"
HEADER_PREFIXES = (TRANSACTION_HEADER_PREFIX, PRODUCT_HEADER_PREFIX)
TRANSACTION_HEADER = "orderId,customerId,productId,quantity,unitPrice,country,orderDate"
PRODUCT_HEADER = "productId,productName,category,basePrice"

WRONG_FIELD_COUNT = "WrongFieldCount"
NOT_A_NUMBER = "NotANumber"
OUT_OF_RANGE = "OutOfRange"
MISSING_FIELD = "MissingField"

# characters String.trim removes: everything up to and including the space
_TRIM_CHARS = "".join(chr(c) for c in range(0x21))
# spellings Spark's cast accepts but the JVM number grammar does not
_SPARK_ONLY_SPECIALS = r"^[+-]?(inf|infinity|nan)$"
_JVM_SPECIALS = r"^[+-]?(NaN|Infinity)$"
_INT_MAX = 2147483647.0


@dataclass(frozen=True)
class Field:
    """One input field: ``label`` as named in reasons, output ``column``, ``kind``.

    ``kind`` is ``text`` (non-empty string), ``positive`` (double > 0) or
    ``positive_int`` (double > 0, then truncated to INT).
    """

    label: str
    column: str
    kind: str = "text"


@dataclass(frozen=True)
class LineSpec:
    fields: tuple[Field, ...]

    @property
    def columns(self) -> list[str]:
        return [f.column for f in self.fields]


TRANSACTION_SPEC = LineSpec(
    (
        Field("orderId", "order_id"),
        Field("customerId", "customer_id"),
        Field("productId", "product_id"),
        Field("quantity", "quantity", "positive_int"),
        Field("unitPrice", "unit_price", "positive"),
        Field("country", "country"),
        Field("orderDate", "order_date"),
    )
)

PRODUCT_SPEC = LineSpec(
    (
        Field("productId", "product_id"),
        Field("productName", "product_name"),
        Field("category", "category"),
        Field("basePrice", "base_price", "positive"),
    )
)


def is_header(line: Column | str = "value", prefixes=HEADER_PREFIXES) -> Column:
    """True when the line starts with any header prefix (at any position in a file)."""
    col = F.col(line) if isinstance(line, str) else line
    cond = None
    for p in prefixes:
        c = col.startswith(p)
        cond = c if cond is None else (cond | c)
    return cond


def clean_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Drop empty lines and header lines; no trimming (a blank line is data)."""
    q = _quote(line)
    headers = " OR ".join(f"startswith({q}, {_sql_text(p)})" for p in HEADER_PREFIXES)
    return lines.where(f"length({q}) > 0 AND NOT ({headers})")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Text scan (split by file blocks across tasks) minus empty and header lines."""
    return clean_lines(spark.read.text(path))


_TRIM_SQL = _sql_text(_TRIM_CHARS)
_INF = "double('Infinity')"


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def jvm_trim_sql(x: str) -> str:
    """SQL text of ``String.trim`` (drop every character <= U+0020 at both ends)."""
    return f"trim(BOTH {_TRIM_SQL} FROM {x})"


def jvm_double_sql(x: str) -> str:
    """SQL text parsing ``x`` with the JVM ``toDouble`` grammar; NULL where it would throw.

    Spark's cast already delegates to the JVM parser and additionally accepts
    ``inf``/``nan`` spellings in any case; those only ever yield NaN or an
    infinity, so only the (rare) non-finite results are re-checked by regex.
    """
    t = f"try_cast({x} AS DOUBLE)"
    return (
        f"CASE WHEN (isnan({t}) OR abs({t}) = {_INF}) "
        f"AND lower({x}) RLIKE '{_SPARK_ONLY_SPECIALS}' AND NOT {x} RLIKE '{_JVM_SPECIALS}' "
        f"THEN NULL ELSE {t} END"
    )


def jvm_to_int_sql(x: str) -> str:
    """SQL text of ``Double.toInt`` for a value known to be > 0 or NaN
    (truncation, NaN -> 0, saturation at 2**31-1)."""
    return f"CASE WHEN isnan({x}) THEN 0 ELSE CAST(least({x}, {_INT_MAX}D) AS INT) END"


def jvm_trim(column: str) -> Column:
    """``String.trim`` of a string column (the field validators' trim)."""
    return F.expr(jvm_trim_sql(_quote(column)))


def jvm_double(column: str) -> Column:
    """A string column parsed as a JVM double; NULL for text the JVM rejects."""
    return F.expr(jvm_double_sql(_quote(column)))


def jvm_to_int(column: str) -> Column:
    """A positive (or NaN) double column truncated to INT the JVM way."""
    return F.expr(jvm_to_int_sql(_quote(column)))


def parse_lines(lines: DataFrame, spec: LineSpec = TRANSACTION_SPEC, line: str = "value") -> DataFrame:
    """Parse every line; output ``line, error_kind, reason, <spec columns>``.

    Value columns are NULL on rejected rows. Pure projections, no shuffle: the
    parse runs in the scan's tasks inside whole-stage codegen. The split, the
    trimmed fields, the numbers and the outcome are separate projection levels,
    so each is computed once per row and then referenced by the checks. Each
    level is one SQL ``selectExpr`` (a single call into the JVM).
    """
    n = len(spec.fields)
    numeric = [i for i, f in enumerate(spec.fields) if f.kind != "text"]
    q = _quote(line)
    split = lines.selectExpr(f"{q} AS line", f"split({q}, ',', -1) AS _parts")
    fields = split.selectExpr(
        "line", "size(_parts) AS _n", *[f"{jvm_trim_sql(f'get(_parts, {i})')} AS _f{i}" for i in range(n)]
    )
    typed = fields.selectExpr("*", *[f"{jvm_double_sql(f'_f{i}')} AS _d{i}" for i in numeric])

    def fail(kind: str, reason: str) -> str:
        return f"named_struct('kind', '{kind}', 'reason', {reason})"

    whens = [f"WHEN _n <> {n} THEN {fail(WRONG_FIELD_COUNT, f'concat({_sql_text(f"expected {n} fields but found ")}, CAST(_n AS STRING))')}"]
    for i, f in enumerate(spec.fields):
        if f.kind == "text":
            whens.append(f"WHEN length(_f{i}) = 0 THEN {fail(MISSING_FIELD, _sql_text(f'field {f.label} is empty'))}")
        else:
            nan_reason = f"concat({_sql_text(f'field {f.label} is not a number: ' + chr(39))}, _f{i}, {_sql_text(chr(39))})"
            range_reason = f"concat({_sql_text(f'field {f.label} is out of range: ' + chr(39))}, _f{i}, {_sql_text(chr(39))})"
            whens.append(f"WHEN _d{i} IS NULL THEN {fail(NOT_A_NUMBER, nan_reason)}")
            whens.append(f"WHEN _d{i} <= 0D THEN {fail(OUT_OF_RANGE, range_reason)}")
    checked = typed.selectExpr("*", "CASE " + " ".join(whens) + " END AS _outcome")
    # Only the outcome goes through the one-row generator. It keeps filters on the
    # outcome above it (pushed below, they would copy every check), while the value
    # columns stay ordinary projections that are pruned where nobody reads them.
    # The outcome goes in whole: by its fields, the optimizer would take them apart
    # below and walk all checks once for each.
    judged = checked.selectExpr("*", "inline(array(_outcome)) AS (error_kind, reason)")
    outputs = ["line", "error_kind", "reason"]
    for i, f in enumerate(spec.fields):
        v = f"_f{i}" if f.kind == "text" else f"_d{i}"
        if f.kind == "positive_int":
            v = jvm_to_int_sql(v)
        outputs.append(f"CASE WHEN reason IS NULL THEN {v} END AS `{f.column}`")
    return judged.selectExpr(*outputs)


def accepted(parsed: DataFrame, spec: LineSpec = TRANSACTION_SPEC) -> DataFrame:
    """Accepted records (value columns only)."""
    return parsed.where(F.col("reason").isNull()).select(*spec.columns)


def rejected(parsed: DataFrame) -> DataFrame:
    """Refused lines: ``reason`` (using trimmed field text) and the raw ``line``."""
    return parsed.where(F.col("reason").isNotNull()).select("reason", "line")


def quality_summary(parsed: DataFrame) -> DataFrame:
    """One row: accepted, rejected and the rejected share in percent (0 when empty).

    A single pass with two conditional counts.
    """
    acc = F.count_if(F.col("reason").isNull())
    rej = F.count_if(F.col("reason").isNotNull())
    return parsed.agg(acc.alias("accepted"), rej.alias("rejected")).select(
        "accepted",
        "rejected",
        F.when(F.col("accepted") + F.col("rejected") <= 0, F.lit(0.0))
        .otherwise(F.col("rejected").cast("double") * F.lit(100.0) / (F.col("accepted") + F.col("rejected")))
        .alias("rejected_share"),
    )


class Outcomes:
    """A parse written once, parted by outcome, with its counts as a by-product.

    The write scans the text once; ``accepted`` and ``rejected`` each read their own
    folder, and ``summary`` comes from metrics that the write observed, without a job.
    """

    def __init__(self, parsed: DataFrame, path: str, spec: LineSpec = TRANSACTION_SPEC):
        spark = parsed.sparkSession
        seen = Observation()
        outcome = F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected"))
        counted = parsed.observe(
            seen, F.count_if(F.col("reason").isNull()).alias("accepted"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
        counted.withColumn("_outcome", outcome).write.partitionBy("_outcome").parquet(path)
        self.path, self.spec, self.counts = path, spec, seen.get
        self.rows = spark.read.schema(T.StructType([*parsed.schema, T.StructField("_outcome", T.StringType())])).parquet(path)

    @property
    def accepted(self) -> DataFrame:
        return self.rows.where("_outcome = 'accepted'").select(*self.spec.columns)

    @property
    def rejected(self) -> DataFrame:
        return self.rows.where("_outcome = 'rejected'").select("reason", "line")

    @property
    def summary(self) -> DataFrame:
        """As :func:`quality_summary`, from the observed counts."""
        n = {k: int(self.counts.get(k) or 0) for k in ("accepted", "rejected")}
        total = n["accepted"] + n["rejected"]
        share = n["rejected"] * 100.0 / total if total else 0.0
        return self.rows.sparkSession.range(0, 1, 1, 1).selectExpr(
            f"CAST({n['accepted']} AS BIGINT) AS accepted", f"CAST({n['rejected']} AS BIGINT) AS rejected", f"CAST('{share!r}' AS DOUBLE) AS rejected_share")


def rejects_by_kind(parsed: DataFrame) -> DataFrame:
    """Number of refused lines per error kind."""
    return (
        parsed.where(F.col("reason").isNotNull())
        .groupBy("error_kind")
        .agg(F.count(F.lit(1)).alias("count"))
    )
