"""Line damage by position: the rule that the run's text lines carry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value that must equal the reference's: damage period in lines.
CORRUPTION_PERIOD = 977
DAMAGED_FIELD = 4  # 0-based field index replaced by a word
DAMAGE_WORD = "N/A"


def corrupt_lines(
    lines: DataFrame, position: str = "position", value: str = "value", period: int = CORRUPTION_PERIOD
) -> DataFrame:
    """Damage lines by their 0-based position ``p``.

    ``p > 0 and p % period == 0``: field 4 becomes ``N/A`` (a NotANumber reject);
    else ``p > period and p % (3 * period) == 1``: the last field is dropped (a
    WrongFieldCount reject). A per-row projection: no shuffle.
    """
    p = F.col(position)
    parts = F.split(F.col(value), ",", -1)
    n = F.size(parts)
    worded = F.array_join(
        F.concat(
            F.slice(parts, F.lit(1), F.lit(DAMAGED_FIELD)),
            F.array(F.lit(DAMAGE_WORD)),
            F.slice(parts, F.lit(DAMAGED_FIELD + 2), F.greatest(n - F.lit(DAMAGED_FIELD + 1), F.lit(0))),
        ),
        ",",
    )
    shortened = F.array_join(F.slice(parts, F.lit(1), F.greatest(n - F.lit(1), F.lit(0))), ",")
    damaged = (
        F.when((p > 0) & (p % period == 0) & (n > F.lit(DAMAGED_FIELD)), worded)
        .when((p > period) & (p % (3 * period) == 1), shortened)
        .otherwise(F.col(value))
    )
    return lines.withColumn(value, damaged)


def corrupt_fields(
    fields: DataFrame, columns: list[str], position: str = "position", period: int = CORRUPTION_PERIOD
) -> DataFrame:
    """The rule of :func:`corrupt_lines` applied to field columns before they are
    joined into a line: field 4 becomes ``N/A``, or the last field becomes NULL
    (``concat_ws`` then leaves it out). Cheaper than re-splitting the line and
    keeps the line expression small when a filter above it is pushed down.
    """
    q = f"`{position}`"
    worded = f"({q} > 0 AND {q} % {period} = 0)"
    shortened = f"(NOT {worded} AND {q} > {period} AND {q} % {3 * period} = 1)"
    out = []
    for i, c in enumerate(columns):
        expr = f"`{c}`"
        if i == DAMAGED_FIELD:
            expr = f"CASE WHEN {worded} THEN '{DAMAGE_WORD}' ELSE {expr} END"
        if i == len(columns) - 1:
            expr = f"CASE WHEN {shortened} THEN CAST(NULL AS STRING) ELSE {expr} END"
        out.append(f"{expr} AS `{c}`")
    return fields.selectExpr(q, *out)
