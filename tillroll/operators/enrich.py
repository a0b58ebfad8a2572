"""Join order lines to the catalog, compute revenue, and filter lines."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import quote, round_money_sql
from tillroll.operators.skew import only_known, salted
from tillroll.session import shuffle_partitions

# Salts of a hot key, for each shuffle partition.
SALTS_PER_PARTITION = 8


def enrich(
    lines: DataFrame,
    catalog: DataFrame,
    key: str = "product_id",
    *,
    quantity: str = "quantity",
    unit_price: str = "unit_price",
    catalog_columns: Sequence[str] = ("product_name", "category"),
    revenue: str = "revenue",
    join_hint: str | None = None,
    salt_buckets: int = 1,
    spread_hot: bool = False,
    prefilter: bool = False,
) -> DataFrame:
    """Inner equi-join of ``lines`` to ``catalog`` on ``key`` plus a revenue column.

    * Lines without a catalog match disappear; duplicate catalog keys fan out.
    * The key itself and every catalog column not listed are dropped; the unit
      price is the line's own, not the catalog's.
    * ``revenue = round_money(quantity * unit_price)``.

    Scale: the catalog side is pruned to ``key + catalog_columns``; whether it is
    broadcast is left to the byte sizes that the planner and AQE see, unless
    ``join_hint`` (such as ``merge`` or ``shuffle_hash``) asks for a shuffle join.
    ``salt_buckets > 1`` spreads each key over that many buckets: lines get a
    deterministic ``pmod(xxhash64(line columns), n)`` salt and catalog rows are
    replicated once per bucket, so each line still meets each matching catalog row
    exactly once (identical lines share a bucket). ``spread_hot`` does that for the hot
    keys alone, which a frequent-items sketch over the lines finds: their lines are
    dealt over eight salts a shuffle partition and only their catalog rows are copied
    (:mod:`tillroll.operators.skew`). ``prefilter`` drops lines that no catalog row can
    match before they are shuffled, by a Bloom filter of the catalog's keys. Both read
    their side once more, key column only; results are the same. AQE splits skewed
    partitions of every form.
    """
    cat = catalog.select(key, *catalog_columns)
    if prefilter:
        lines = only_known(lines, cat, key)

    def hinted(side: DataFrame) -> DataFrame:
        return side.hint(join_hint) if join_hint else side

    keep = [c for c in lines.columns if c != key]
    if spread_hot:
        parts = shuffle_partitions(lines.sparkSession)
        salted_lines, salted_cat = salted(lines, cat, key, parts, SALTS_PER_PARTITION * parts)
        joined = salted_lines.join(hinted(salted_cat), [key, "_salt"], "inner")
    elif salt_buckets and salt_buckets > 1:
        salted_lines = lines.withColumn(
            "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in lines.columns]), F.lit(salt_buckets))
        )
        salted_cat = cat.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1)).cast("array<bigint>"))
        )
        joined = salted_lines.join(hinted(salted_cat), [key, "_salt"], "inner")
    else:
        joined = lines.join(hinted(cat), key, "inner")
    revenue_sql = round_money_sql(f"{quote(quantity)} * {quote(unit_price)}")
    return joined.selectExpr(
        *[quote(c) for c in keep],
        *[quote(c) for c in catalog_columns],
        f"{revenue_sql} AS {quote(revenue)}",
    )


def at_least_revenue(threshold: float, column: str = "revenue") -> Column:
    """Inclusive ``column >= threshold``. NaN never passes (JVM semantics; Spark
    orders NaN above every number, so the guard is explicit)."""
    col = F.col(column)
    return (col >= F.lit(float(threshold))) & ~F.isnan(col)


def keep_significant(df: DataFrame, threshold: float, column: str = "revenue") -> DataFrame:
    """Rows whose amount is at least ``threshold`` (a Catalyst-visible filter)."""
    return df.where(at_least_revenue(threshold, column))


def shipped_to(
    df: DataFrame,
    countries: Iterable[str] | DataFrame,
    column: str = "country",
    *,
    countries_column: str | None = None,
) -> DataFrame:
    """Rows whose ``column`` is in ``countries``.

    A Python collection becomes an ``IN`` list (pushed to the scan); a DataFrame
    of countries becomes a left-semi join, which scales to any set size.
    """
    if isinstance(countries, DataFrame):
        other = countries_column or countries.columns[0]
        wanted = countries.select(F.col(other).alias("_wanted")).distinct()
        return df.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
    return df.where(F.col(column).isin(list(countries)))
