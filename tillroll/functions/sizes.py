"""Order-size classes: half-open revenue bands, labels and descriptions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.text import sql_text
from tillroll.session import literal_table

# Fixed values that must equal the reference's for identical reports:
# class labels cheapest -> dearest, and the default band limits in dollars.
SIZE_LABELS = ("SMALL", "MEDIUM", "LARGE", "PREMIUM")
DEFAULT_LIMITS = (50.0, 200.0, 1000.0)


def java_double_text(value: float) -> str:
    """``Double.toString`` text of a double (shortest digits, Java layout)."""
    value = float(value)
    if value != value:
        return "NaN"
    if value in (float("inf"), float("-inf")):
        return "Infinity" if value > 0 else "-Infinity"
    magnitude = abs(value)
    if magnitude == 0.0 or 1e-3 <= magnitude < 1e7:
        return repr(value)
    _, digits, exponent = Decimal(repr(magnitude)).normalize().as_tuple()
    power = len(digits) - 1 + exponent
    tail = "".join(str(d) for d in digits[1:]) or "0"
    return f"{'-' if value < 0 else ''}{digits[0]}.{tail}E{power}"


def describe_limits(limits: Sequence[float] = DEFAULT_LIMITS) -> list[str]:
    """Text for each class: ``below A dollars``, ``between A and B``, ``at least C dollars``."""
    texts = [java_double_text(x) for x in limits]
    out = [f"below {texts[0]} dollars"]
    out += [f"between {lo} and {hi}" for lo, hi in zip(texts, texts[1:])]
    out.append(f"at least {texts[-1]} dollars")
    return out


def classify_order(
    amount: Column | str,
    limits: Sequence[float] = DEFAULT_LIMITS,
    labels: Sequence[str] = SIZE_LABELS,
) -> Column:
    """``CASE WHEN amount < l0 THEN label0 WHEN amount < l1 ...`` (half-open bands).

    NaN is not below any limit and lands in the last class, as in the JVM; a NULL
    amount has no class (NULL).
    """
    if len(labels) != len(limits) + 1:
        raise ValueError("need exactly one more label than limits")
    if isinstance(amount, str):
        q = "`" + amount.replace("`", "``") + "`"
        whens = " ".join(
            f"WHEN {q} < {float(limit)!r}D THEN {sql_text(label)}" for limit, label in zip(limits, labels)
        )
        return F.expr(f"CASE {whens} WHEN {q} IS NOT NULL THEN {sql_text(labels[-1])} END")
    col = amount
    expr = None
    for limit, label in zip(limits, labels):
        cond = col < F.lit(float(limit))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(col.isNotNull(), F.lit(labels[-1]))


def describe_size(
    size: Column | str,
    limits: Sequence[float] = DEFAULT_LIMITS,
    labels: Sequence[str] = SIZE_LABELS,
) -> Column:
    """Map a size label column to its description text."""
    col = F.col(size) if isinstance(size, str) else size
    expr = None
    for label, text in zip(labels, describe_limits(limits)):
        cond = col == F.lit(label)
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def size_dimension(
    spark: SparkSession,
    limits: Sequence[float] = DEFAULT_LIMITS,
    labels: Sequence[str] = SIZE_LABELS,
) -> DataFrame:
    """One row per class: ``rank, size, lower, upper, description`` (a tiny literal table)."""
    bounds = [None, *[float(x) for x in limits], None]
    rows = [
        (rank, label, bounds[rank], bounds[rank + 1], text)
        for rank, (label, text) in enumerate(zip(labels, describe_limits(limits)))
    ]
    columns = [("rank", "int"), ("size", "string"), ("lower", "double"), ("upper", "double"), ("description", "string")]
    return literal_table(spark, columns, rows)
