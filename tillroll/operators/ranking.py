"""Top-k and cumulative-share (Pareto) analytics.

Ties are broken by the key column so results do not depend on shuffle order.

Cumulative results over many rows need no single task. Rows are cut into ranges of
the wanted order, as many as the session's shuffle partitions, by splitters: quantiles of
the rows with the smallest hashes (a deterministic sample: every evaluation of the plan
gives the same ranges). Rows with equal score and keys are parted by a hash of the row.
Each range is numbered or summed on its own, and the ranges' totals, one small row each,
give the offsets. Everything is one lazy plan: one exchange of the rows, by range, but the
input is evaluated for the splitters, the offsets and the rows;
:class:`tillroll.operators.ordered.Ordered` writes the rows once instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import cents_sql, quote, round_money
from tillroll.operators.aggregates import spending_by_customer
from tillroll.session import shuffle_partitions

# Sampled rows per range; ranges come out even within some 10 %.
SAMPLE_PER_RANGE = 16


def top_by(df: DataFrame, n: int, score: str, keys: str | Sequence[str] = ()) -> DataFrame:
    """The ``n`` rows with the highest ``score`` in that order; ties by ascending ``keys``.

    ``n`` larger than the input returns every row, ``n <= 0`` none. Lazy for every
    ``n`` (``TakeOrderedAndProject``: each partition keeps its own top ``n``). It is
    meant for report-sized ``n``; a large ordered prefix comes from
    :meth:`tillroll.operators.ordered.Ordered.first`, which never gathers ``n`` rows in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.orderBy(F.desc(score), *[F.asc(k) for k in keys]).limit(max(int(n), 0))


def _order_struct(score: str, keys: Sequence[str], columns: Sequence[str]) -> str:
    """A struct whose ascending order is ``score`` descending, then ``keys`` ascending
    (NaN first, as Spark orders it above every number; NULL last), then a hash of the row."""
    s = f"CAST({quote(score)} AS DOUBLE)"
    fields = [f"'n', {s} IS NULL", f"'f', NOT coalesce(isnan({s}), false)", f"'s', IF(isnan({s}), 0D, -{s})"]
    fields += [f"'k{i}', {quote(k)}" for i, k in enumerate(keys)]
    fields.append(f"'h', xxhash64({', '.join(map(quote, columns))})")
    return f"named_struct({', '.join(fields)})"


def _ranged(df: DataFrame, score: str, keys: Sequence[str], ranges: int | None) -> DataFrame:
    """``df`` plus ``_o`` (order struct) and ``_range`` (0 .. ranges - 1, in order)."""
    ranges = ranges or shuffle_partitions(df.sparkSession)
    ordered = df.selectExpr("*", f"{_order_struct(score, keys, df.columns)} AS _o")
    sample = (
        ordered.select("_o").orderBy(F.xxhash64("_o")).limit(SAMPLE_PER_RANGE * ranges)
        .agg(F.array_sort(F.collect_set("_o")).alias("s"))
    )
    # evenly spaced ones of the sample, all of it if it is small
    even = f"transform(sequence(1, {max(ranges - 1, 1)}), i -> s[CAST(i * size(s) div {ranges} AS INT)])"
    splitters = sample.selectExpr(f"IF(size(s) < {ranges} OR {ranges} = 1, slice(s, 1, {ranges - 1}), {even}) AS s")
    placed = ordered.withColumn("_s", splitters.scalar())
    return placed.withColumn("_range", F.expr("size(filter(_s, s -> s < _o))")).drop("_s")


def _offsets(ranged: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Per range the sums over all ranges before it; at most one row per range, so the
    ordered window and the broadcast over it are bounded by the number of ranges."""
    totals = ranged.groupBy("_range").agg(*[F.expr(f"{e} AS {c}") for c, e in sums.items()])
    before = "OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return F.broadcast(totals.selectExpr(
        "_range",
        *[f"coalesce(sum({c}) {before}, 0) AS {c}_before" for c in sums],
        *[f"sum({c}) OVER () AS {c}_all" for c in sums],
    ))


def number_rows(df: DataFrame, score: str, keys: Sequence[str] = (), *, ranges: int | None = None) -> DataFrame:
    """``df`` plus ``_pos``: its 1-based position by ``score`` descending, then ``keys``."""
    ranged = _ranged(df, score, list(keys), ranges)
    offsets = _offsets(ranged, {"_n": "count(1)"})
    return ranged.join(offsets, "_range").selectExpr(
        *[quote(c) for c in df.columns],
        "CAST(row_number() OVER (PARTITION BY _range ORDER BY _o) + _n_before AS BIGINT) AS _pos",
    )


def top_customers(
    df: DataFrame, n: int, key: str = "customer_id", *, amount: str = "revenue"
) -> DataFrame:
    """Top ``n`` customers by exact total spent (no collect)."""
    return top_by(spending_by_customer(df, key, amount=amount), n, "total_spent", key)


def share(cum: str, total: str):
    """``round_money(cum / total * 100)``, or 0 when the total is not positive."""
    return F.when(F.col(total) <= F.lit(0), F.lit(0.0)).otherwise(
        round_money(F.col(cum) / F.col(total) * F.lit(100.0))
    )


def framed_window(report: DataFrame, key: str, amount: str) -> DataFrame:
    """Running sums with one ordered window: a single task, for reports of a few rows."""
    k = quote(key)
    order = f"_amt DESC, {k} ASC"
    return report.selectExpr(k, f"{quote(amount)} AS _amt", f"{cents_sql(quote(amount))} AS _c").selectExpr(
        k,
        "_amt",
        f"CAST(sum(_c) OVER (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS _cum",
        "CAST(sum(_c) OVER () AS DOUBLE) AS _total",
        f"CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS _pos",
    )


def _framed_ranged(report: DataFrame, key: str, amount: str, ranges: int | None) -> DataFrame:
    """Running sums over any number of keys, range by range."""
    k = quote(key)
    base = report.selectExpr(k, f"{quote(amount)} AS _amt", f"{cents_sql(quote(amount))} AS _c")
    ranged = _ranged(base, "_amt", [key], ranges)
    offsets = _offsets(ranged, {"_c_sum": "sum(_c)", "_n": "count(1)"})
    inside = "OVER (PARTITION BY _range ORDER BY _o ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    return ranged.join(offsets, "_range").selectExpr(
        k,
        "_amt",
        f"CAST(sum(_c) {inside} + _c_sum_before AS DOUBLE) AS _cum",
        "CAST(_c_sum_all AS DOUBLE) AS _total",
        f"CAST(count(1) {inside} + _n_before AS BIGINT) AS _pos",
    )


def _framed(report: DataFrame, key: str, amount: str, method: str, ranges: int | None) -> DataFrame:
    if method == "window":
        return framed_window(report, key, amount)
    if method == "ranged":
        return _framed_ranged(report, key, amount, ranges)
    raise ValueError(f"unknown Pareto method {method!r}; use 'window' or 'ranged'")


def pareto(
    report: DataFrame,
    key: str = "category",
    amount: str = "revenue",
    *,
    method: str = "ranged",
    ranges: int | None = None,
) -> DataFrame:
    """Cumulative share of ``amount`` by descending amount (ties by key).

    Output ``key, revenue, cumulative_share``: the running sum and the total are
    taken over the cent-rounded amounts (exact decimal cents), share =
    ``round_money(running / total * 100)``, 0 when the total is not positive.
    ``method="ranged"`` suits any number of keys; ``method="window"`` is one task
    for a report known to be short. Both give identical results.
    """
    framed = _framed(report, key, amount, method, ranges)
    return framed.select(
        F.col(key),
        round_money("_amt").alias("revenue"),
        share("_cum", "_total").alias("cumulative_share"),
    )


def keys_to_reach(
    report: DataFrame,
    threshold: float,
    key: str = "category",
    amount: str = "revenue",
    *,
    method: str = "ranged",
    ranges: int | None = None,
) -> DataFrame:
    """How many leading keys reach ``threshold`` percent of the total.

    Equals ``min(len(takeWhile(share < threshold)) + 1, n)``: the position of
    the first row whose share is not below the threshold, else ``n``; 0 over an
    empty report. Exact without assuming the shares are monotone.
    """
    framed = _framed(report, key, amount, method, ranges)
    reached = F.when(share("_cum", "_total") >= F.lit(float(threshold)), F.col("_pos"))
    return framed.agg(
        F.coalesce(F.min(reached), F.count(F.lit(1))).cast("long").alias("keys_needed"),
        F.count(F.lit(1)).alias("keys_total"),
    )
