"""Rows in a total order, written once by range and read by everything that needs it.

``Ordered.of`` evaluates its input once: Spark's range partitioner samples every
partition (weighted by its rows), cuts the order into ranges of even size, as many as
the session's shuffle partitions, and the rows go to Parquet, sorted, each with ``_at``, its
range and place in it (``range << 33 | place``). Rows with equal score and keys are parted
by a hash of the row, so one value that holds a third of all rows spreads over many
ranges. Everything after reads the written rows:

* numbering adds the sizes of the ranges before: no shuffle and no sort;
* running sums add the totals of the ranges before to a sum inside each range;
* the first ``n`` rows are one pushed-down filter on ``_at``;
* the place where a share is reached is looked for in the one range whose totals
  cross it; the other ranges' rows are not read.

What is ordered as a whole or broadcast is one row per range. The written folder lies
below ``spark.checkpoint.dir``, so lost executors cost nothing before it; ``release`` (or the
``with`` statement) deletes it when no frame reads it any more.

Defined results: an empty input has no rows and reaches any share after 0 keys; a null
score comes last, NaN first; rows that are equal in every column may be given more than
one range only with ``split_copies``, which numbers them before they are dealt (one more
write).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.money import cents_sql, quote, round_money
from tillroll.operators.ranking import share
from tillroll.session import drop_folder, shared_folder, written

# Bits of ``_at`` below the range: the layout of monotonically_increasing_id.
PLACE_BITS = 33
RESERVED = frozenset(("_at", "_pos", "_range", "_copy", "_n", "_n_before", "_n_all", "_c", "_c_before", "_c_all", "_cum", "_total"))


class Ordered:
    """Rows written in order of ``score`` descending, then ``keys``; see the module."""

    def __init__(self, rows: DataFrame, path: str, score: str):
        self.rows, self.path, self.score = rows, path, score
        self.columns = [c for c in rows.columns if c != "_at"]

    @classmethod
    def of(cls, df: DataFrame, score: str, keys: str | Sequence[str] = (), *, ranges: int | None = None,
           split_copies: bool = False) -> "Ordered":
        """Write ``df`` in order. ``ranges``: how many (default: the session's shuffle
        partitions; small ones are merged by AQE)."""
        taken = RESERVED.intersection(df.columns)
        if taken:
            raise ValueError(f"columns {sorted(taken)} are the names that ordered rows use themselves")
        keys = [keys] if isinstance(keys, str) else list(keys)
        spark, copies = df.sparkSession, None
        order = [F.col(quote(score)).cast("double").desc_nulls_last(), *[F.col(quote(k)).asc() for k in keys]]
        if split_copies:
            # fixed in files first: a repeated task must find the same numbers
            copies = shared_folder(spark, "copies")
            df = written(df.withColumn("_copy", F.monotonically_increasing_id()), copies)
        order.append(F.xxhash64(*[quote(c) for c in df.columns]).asc())
        dealt = df.repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
        path = shared_folder(spark, "ordered")
        rows = written(dealt.drop("_copy").withColumn("_at", F.monotonically_increasing_id()), path)
        if copies:
            drop_folder(spark, copies)
        return cls(rows, path, score)

    def __enter__(self) -> "Ordered":
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def release(self) -> None:
        drop_folder(self.rows.sparkSession, self.path)

    def totals(self, **sums: str) -> DataFrame:
        """One row per range: ``_range``, ``_n`` and the given SQL sums, each also as
        ``<name>_before`` (over the ranges before) and ``<name>_all``."""
        sums = {"_n": "count(1)", **sums}
        each = self.rows.groupBy(F.expr(f"shiftright(_at, {PLACE_BITS})").alias("_range")).agg(
            *[F.expr(f"{e} AS {quote(c)}") for c, e in sums.items()])
        before = "OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        return each.selectExpr(
            "*",
            *[f"coalesce(sum({quote(c)}) {before}, 0) AS {quote(c + '_before')}" for c in sums],
            *[f"sum({quote(c)}) OVER () AS {quote(c + '_all')}" for c in sums],
        )

    def _placed(self, **sums: str) -> DataFrame:
        totals = F.broadcast(self.totals(**sums))  # one row per range
        return self.rows.withColumn("_range", F.expr(f"shiftright(_at, {PLACE_BITS})")).join(totals, "_range")

    def numbered(self) -> DataFrame:
        """The rows plus ``_pos``, their position from 1."""
        place = f"_n_before + (_at & {(1 << PLACE_BITS) - 1}L) + 1"
        return self._placed().selectExpr(*map(quote, self.columns), f"CAST({place} AS BIGINT) AS _pos")

    def cumulated(self, amount: str | None = None) -> DataFrame:
        """The rows plus ``_pos``, ``_cum`` (running sum of the cent-rounded amount) and
        ``_total``; ``amount`` is the score by default."""
        cents = cents_sql(quote(amount or self.score))
        inside = "OVER (PARTITION BY _range ORDER BY _at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        return self._placed(_c=f"sum({cents})").selectExpr(
            *map(quote, self.columns),
            f"CAST(_n_before + (_at & {(1 << PLACE_BITS) - 1}L) + 1 AS BIGINT) AS _pos",
            f"CAST(sum({cents}) {inside} + _c_before AS DOUBLE) AS _cum",
            "CAST(_c_all AS DOUBLE) AS _total",
        )

    def pareto(self, key: str) -> DataFrame:
        """As :func:`tillroll.operators.ranking.pareto` over these rows."""
        amount = quote(self.score)
        return self.cumulated().select(
            F.col(quote(key)), round_money(F.col(amount)).alias("revenue"), share("_cum", "_total").alias("cumulative_share"))

    def first(self, n: int) -> DataFrame:
        """The first ``n`` rows, in order: every whole range before the ``n``-th row and
        a prefix of its own, so no task holds more than a range."""
        own = list(map(quote, self.columns))
        n = max(int(n), 0)
        last = self.totals().where(f"_n_before < {n} AND _n_before + _n >= {n}").selectExpr("_range", "_n_before").first()
        rows = self.rows if last is None else self.rows.where(f"_at < {(last[0] << PLACE_BITS) + n - last[1]}L")
        if n == 0:
            rows = self.rows.where("_at < 0L")
        return rows.orderBy("_at").selectExpr(*own)

    def keys_to_reach(self, threshold: float) -> DataFrame:
        """As :func:`tillroll.operators.ranking.keys_to_reach` over these rows.

        Inside a range amounts fall, so its running sum is highest where the positive
        ones end: the first range whose sum up to there reaches the share holds the
        place, and only that range is read and ordered.
        """
        spark, goal = self.rows.sparkSession, F.lit(float(threshold))
        cents = cents_sql(quote(self.score))
        totals = self.totals(_c=f"sum({cents})", _up=f"sum(greatest({cents}, 0))").selectExpr(
            "*", "CAST(_c_before + _up AS DOUBLE) AS _peak", "CAST(_c_all AS DOUBLE) AS _total")
        hit = totals.where(share("_peak", "_total") >= goal).orderBy("_range").first()
        if hit is None:
            return self.rows.agg(F.count(F.lit(1)).alias("keys_needed"), F.count(F.lit(1)).alias("keys_total"))
        low = hit["_range"] << PLACE_BITS
        inside = "OVER (ORDER BY _at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"  # one range
        framed = self.rows.where(f"_at >= {low}L AND _at < {low + (1 << PLACE_BITS)}L").selectExpr(
            f"{hit['_n_before']}L + (_at & {(1 << PLACE_BITS) - 1}L) + 1 AS _pos",
            f"CAST(sum({cents}) {inside} + CAST('{hit['_c_before']}' AS DECIMAL(38,0)) AS DOUBLE) AS _cum",
            f"CAST(CAST('{hit['_c_all']}' AS DECIMAL(38,0)) AS DOUBLE) AS _total",
        )
        return framed.where(share("_cum", "_total") >= goal).agg(
            F.min("_pos").cast("long").alias("keys_needed"), F.lit(hit["_n_all"]).cast("long").alias("keys_total"))
