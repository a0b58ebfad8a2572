"""Money arithmetic as native column expressions.

Amounts are binary doubles rounded to whole cents the JVM way:
``Math.round(x * 100) / 100``, i.e. half toward +infinity applied to the
*binary* product (1.005 -> 1.0, unlike ``F.round`` which gives 1.01). Sums are
taken in wide decimals, so they are order-free and identical on every
partitioning.

Each helper accepts a column name (built as one SQL expression, a single call
into the JVM) or a Column (built with the function API).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = 100.0
# Above 2**52 every double is a whole number, so rounding is the identity there.
_WHOLE_ABOVE = float(2**52)


def quote(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def round_money_sql(x: str) -> str:
    """SQL text of :func:`round_money` for the SQL expression ``x``."""
    s = f"(({x}) * 100D)"
    return (
        f"((CASE WHEN abs({s}) < 4503599627370496D "
        f"THEN floor({s}) + CASE WHEN {s} - floor({s}) >= 0.5D THEN 1 ELSE 0 END "
        f"ELSE floor({s}) END) / 100D)"
    )


def cents_sql(x: str) -> str:
    """SQL text of :func:`cents` for the SQL expression ``x``."""
    return f"CAST(round(({x}) * 100D) AS DECIMAL(28,0))"


def round_money(amount: Column | str) -> Column:
    """``Math.round(amount * 100) / 100.0`` bit for bit.

    ``floor(s) + (s - floor(s) >= 0.5)`` is exact below 2**52 (the fraction is
    computed without rounding), avoiding the one-ulp error of ``floor(s + 0.5)``.
    NaN gives 0.0 and +-infinity saturate to +-2**63 / 100, as in the JVM.
    """
    if isinstance(amount, str):
        return F.expr(round_money_sql(quote(amount)))
    scaled = amount * F.lit(CENTS)
    low = F.floor(scaled)
    rounded = F.when(
        F.abs(scaled) < F.lit(_WHOLE_ABOVE),
        low + F.when(scaled - low >= F.lit(0.5), F.lit(1)).otherwise(F.lit(0)),
    ).otherwise(low)
    return rounded / F.lit(CENTS)


def revenue_of(quantity: Column | str, unit_price: Column | str) -> Column:
    """Line revenue: quantity times unit price, rounded to cents."""
    if isinstance(quantity, str) and isinstance(unit_price, str):
        return F.expr(round_money_sql(f"{quote(quantity)} * {quote(unit_price)}"))
    q = F.col(quantity) if isinstance(quantity, str) else quantity
    p = F.col(unit_price) if isinstance(unit_price, str) else unit_price
    return round_money(q * p)


def cents(amount: Column | str) -> Column:
    """Whole cents (DECIMAL) of an amount that is already cent-rounded."""
    if isinstance(amount, str):
        return F.expr(cents_sql(quote(amount)))
    return F.round(amount * F.lit(CENTS)).cast("decimal(28,0)")


def money_sum_sql(x: str) -> str:
    """SQL text of :func:`money_sum` for the SQL expression ``x``."""
    odd = f"(isnan({x}) OR abs({x}) >= 1e18D)"
    exact = f"CAST(sum(IF({odd}, NULL, CAST(IF({odd}, 0D, {x}) AS DECIMAL(28,9)))) AS DOUBLE)"
    total = f"(coalesce({exact}, 0D) + coalesce(sum(IF({odd}, {x}, NULL)), 0D))"
    return f"IF(count({x}) = 0, NULL, {round_money_sql(total)})"


def money_sum(amount: Column | str) -> Column:
    """Sum of amounts, added exactly and rounded to cents once; NULL over no amounts.

    Ordinary amounts add up in ``DECIMAL(38,9)``: independent of how rows are split
    across partitions (a double fold is not), exact below a cent, and wide enough
    for 10**12 rows of the largest rounded price. Amounts of 1e18 and more, and NaN
    or infinite ones, add up as doubles. The result is rounded and saturated once,
    as the JVM rounds: +-infinity gives +-2**63 / 100, NaN gives 0.0.
    """
    if isinstance(amount, str):
        return F.expr(money_sum_sql(quote(amount)))
    odd = F.isnan(amount) | (F.abs(amount) >= F.lit(1e18))
    exact = F.sum(F.when(~odd, F.when(odd, F.lit(0.0)).otherwise(amount).cast("decimal(28,9)"))).cast("double")
    total = F.coalesce(exact, F.lit(0.0)) + F.coalesce(F.sum(F.when(odd, amount)), F.lit(0.0))
    return F.when(F.count(amount) > 0, round_money(total))
