"""Whitening against exact sums and the eigenvectors of the exact covariance."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>"


def reference(rows, keep, scale=256):
    """{(row number, component): (n, deviation, |whitened|, explained)} in exact sums."""
    usable = [(i, v) for i, v in enumerate(rows) if v is not None and v and all(c is not None and math.isfinite(c) for c in v)]
    x = [(i, tuple(math.floor(scale * float(np.float32(c))) for c in v)) for i, v in usable]
    points = sorted({p for _, p in x})
    sizes = [len(p) for p in points]
    d = max(sizes, key=lambda s: (sizes.count(s), s)) if sizes else 0
    points, x = [p for p in points if len(p) == d], [(i, p) for i, p in x if len(p) == d]
    n = len(points)
    sums = [sum(p[k] for p in points) for k in range(d)]
    t = np.array([[n * p[k] - sums[k] for k in range(d)] for p in points], object)
    exact = t.T @ t  # n**3 times the covariance, whole numbers
    cov = np.array([[float(Fraction(int(v), n**3)) for v in row] for row in exact]) if n else np.zeros((0, 0))
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1].T
    out = {}
    for i, p in x:
        far = [n * p[k] - sums[k] for k in range(d)]
        for k in range(min(keep, d)):
            if values[k] > 1e-12 * values[0]:
                w = sum(float(Fraction(f, n)) * c for f, c in zip(far, vectors[k])) / math.sqrt(values[k])
                out[i, k] = (n, sum(f * f for f in far), w, values[k] / values.sum())
    return out


def check(rows, packed, keep=None):
    fitted = whitening.fit(packed, components=keep)
    want = reference(rows, 10**6 if keep is None else keep)
    got = [(r.vec_id, r.deviation, r.whitened) for r in whitening.whiten(packed, fitted).collect()]
    assert sorted({(i, k) for i, k in want}) == sorted((i, k) for i, _, w in got for k in range(len(w)))
    sign = {}
    for i, dev, w in got:
        for k, v in enumerate(w):
            n, deviation, expected, explained = want[i, k]
            assert dev == (deviation if deviation < 2**63 else None) and n == fitted.n
            if abs(expected) > 1e-3:
                sign.setdefault(k, math.copysign(1, v * expected))
            assert v * sign.get(k, 1) == pytest.approx(expected, abs=1e-7)
            assert fitted.values[k] / fitted.trace == pytest.approx(explained, rel=1e-9)
    assert fitted.identity_error < 1e-9
    return fitted


def spread(rnd, n, d):
    return [[rnd.gauss(3.0 * k, 0.2 + 1.5 ** (k % 7)) for k in range(d)] for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v) for i, v in enumerate(rows)], SCHEMA).repartition(3)


def test_equals_the_exact_covariance(spark):
    rnd = random.Random(1)
    rows = spread(rnd, 200, 6)
    rows += [rows[0]] * 90 + [None, [], [None] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf"), 0.0, 0.0, 0.0, 0.0, 0.0],
             [1.0, 2.0], [1.0] * 9, [-0.0] * 6, [0.0] * 6]
    df = frame(spark, rows).withColumn("d", F.lit("clash")).withColumn("x", F.lit(1)).withColumn("deviation", F.lit(2))
    packed = whitening.pack(df)
    assert packed.count() == 200 + 90 + 2 + 2
    assert check(rows, packed).n == 201
    assert len(check(rows, packed, 4).values) == 4


def test_badly_conditioned_and_rank_deficient(spark):
    rnd = random.Random(2)
    a = [[rnd.gauss(0, 50.0), rnd.gauss(0, 0.01), 4000.0, rnd.gauss(0, 3.0)] for _ in range(150)]
    a = [[*v, v[0], v[0] + 0.25] for v in a]  # a constant entry and copied ones: rank 3
    assert len(check(a, whitening.pack(frame(spark, a))).values) == 3
    few = spread(rnd, 3, 8)  # fewer vectors than dimensions
    assert len(check(few, whitening.pack(frame(spark, few))).values) == 2


def test_no_components(spark):
    for rows in ([], [[1.0, 2.0]] * 5, [None, []]):
        packed = whitening.pack(frame(spark, rows) if rows else spark.createDataFrame([], SCHEMA))
        fitted = whitening.fit(packed)
        assert len(fitted.values) == 0 and whitening.whiten(packed, fitted).count() == 0


def test_wide_entries(spark):
    rnd = random.Random(4)
    rows = [[rnd.choice([1.0, 300.0, 1e6]) * rnd.random(), rnd.random() * 1e9, rnd.random()] for _ in range(60)]
    check(rows, whitening.pack(frame(spark, rows)), 2)
    huge = frame(spark, [[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0]])  # products beyond 64 bits
    packed = whitening.pack(huge)
    got = {r.vec_id: r for r in whitening.whiten(packed, whitening.fit(packed)).collect()}
    assert len(got) == 3 and got[0].deviation is None and got[1].deviation is None
    assert all(map(math.isfinite, [*got[0].whitened, *got[1].whitened, *got[2].whitened]))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = list(rows)
    want = {(ids[i], k + 1): v for (i, k), v in reference(list(rows.values()), 4).items()}
    got = queries.op11_whitening(spark, sf).collect()
    assert {(r.vec_id, r.component) for r in got} == set(want) and len(got) == len(want)
    sign = {}
    for r in got:
        n, deviation, w, explained = want[r.vec_id, r.component]
        assert (r.n, r.deviation) == (n, deviation) and r.explained == pytest.approx(explained, rel=1e-9)
        if abs(w) > 1e-3:
            sign.setdefault(r.component, math.copysign(1, r.whitened * w))
        assert r.whitened * sign.get(r.component, 1) == pytest.approx(w, abs=1e-7)
        assert r.identity_error < 1e-9
    assert np.unique([r.identity_error for r in got]).size == 1
