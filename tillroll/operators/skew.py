"""What a large join needs to know about its keys: the hot ones, and the known ones.

Both are one-row aggregates that merge across partitions and enter the join plan as
scalar subqueries, so a join that uses them stays one lazy plan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.money import quote

# Keys that may be called hot, and the counters of the sketch that looks for them: a
# key above 1 / TRACKED of the rows is always among them.
HOT_KEYS = 64
TRACKED = 8192

# Bits of a key filter per key, and its largest size (16 MB of longs).
BITS_PER_KEY = 16
LEAST_BITS, MOST_BITS = 1 << 12, 1 << 27


def hot_keys(df: DataFrame, key: str, parts: int) -> DataFrame:
    """One row, ``keys``: those that hold more than half of an even share of ``parts``
    tasks, by a frequent-items sketch (``approx_top_k``); at most ``HOT_KEYS``.

    A sketch miscounts, so a key near the limit may fall on either side; that
    changes how rows are dealt, never the result.
    """
    k = quote(key)
    counted = df.where(f"{k} IS NOT NULL").agg(
        F.expr(f"approx_top_k({k}, {HOT_KEYS}, {TRACKED})").alias("top"), F.count(F.lit(1)).alias("n"))
    return counted.selectExpr(f"transform(filter(top, x -> 2 * {int(parts)} * x.count > n), x -> x.item) AS keys")


def salted(lines: DataFrame, catalog: DataFrame, key: str, parts: int, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: lines of a hot key are dealt to ``buckets`` salts by a
    hash of the line and its partition, and only the hot keys' catalog rows are copied,
    once a salt. All other rows have salt 0."""
    hot = hot_keys(lines, key, parts).scalar()
    is_hot = F.coalesce(F.array_contains(hot, F.col(quote(key))), F.lit(False))
    spread = F.pmod(F.xxhash64(*[quote(c) for c in lines.columns], F.spark_partition_id()), F.lit(buckets))
    left = lines.withColumn("_salt", F.when(is_hot, spread).otherwise(F.lit(0).cast("bigint")))
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(F.array(F.lit(0))).cast("array<bigint>")
    return left, catalog.withColumn("_salt", F.explode(salts))


def filter_key(df: DataFrame, key: str) -> str:
    """SQL of a join key as the filter hashes it: whole numbers as BIGINT, and one zero."""
    kind = df.schema[key].dataType
    if isinstance(kind, T.IntegralType):
        return f"CAST({quote(key)} AS BIGINT)"
    return f"({quote(key)} + 0D)" if isinstance(kind, T.DoubleType) else quote(key)


def key_filter(keys: DataFrame, key: str) -> DataFrame:
    """One row, ``words``: a Bloom filter of the keys as 64-bit words, ``BITS_PER_KEY``
    bits for each distinct key (estimated), ``MOST_BITS`` at most. Beyond that it
    lets more unknown keys pass; it never refuses a known one."""
    known = keys.where(f"{quote(key)} IS NOT NULL").selectExpr(f"{filter_key(keys, key)} AS k")
    bits = known.selectExpr(
        f"least({MOST_BITS}L, greatest({LEAST_BITS}L, approx_count_distinct(k) * {BITS_PER_KEY})) AS b"
    ).selectExpr("(b + 63) div 64 * 64 AS b")
    places = known.withColumn("b", bits.scalar()).selectExpr(
        "explode(array(pmod(xxhash64(k), b), pmod(xxhash64(xxhash64(k), 1), b))) AS p")
    words = places.groupBy(F.expr("p div 64").alias("w")).agg(F.expr("bit_or(shiftleft(1L, CAST(p % 64 AS INT)))").alias("v"))
    every = bits.selectExpr("explode(sequence(0L, b div 64 - 1)) AS w")
    filled = every.join(words, "w", "left").selectExpr("named_struct('w', w, 'v', coalesce(v, 0L)) AS s")
    return filled.agg(F.array_sort(F.collect_list("s")).alias("s")).selectExpr("s.v AS words")


def only_known(lines: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """``lines`` without most of those whose key the catalog lacks, and without none
    that it has; the filter runs in the scan's tasks."""
    kinds = [df.schema[key].dataType for df in (lines, catalog)]
    if kinds[0] != kinds[1] and not all(isinstance(k, T.IntegralType) for k in kinds):
        raise ValueError(f"the key filter needs {key!r} to be of one type, not {kinds[0]} and {kinds[1]}")
    words = key_filter(catalog, key).scalar()
    bits = F.size(words).cast("bigint") * 64
    h = F.xxhash64(F.expr(filter_key(lines, key)))
    held = F.col(quote(key)).isNotNull()
    for place in (F.pmod(h, bits), F.pmod(F.xxhash64(h, F.lit(1)), bits)):
        held &= F.getbit(words[(place / 64).cast("int")], (place % 64).cast("int")) == 1
    return lines.where(held)
