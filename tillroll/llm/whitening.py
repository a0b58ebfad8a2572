"""Whitening of embedding vectors by shifted CholeskyQR.

Entries become whole numbers ``floor(scale * c)``; every distinct vector of them counts
once. The centred distinct vectors, as rows of a tall matrix A, are orthogonalised in
distributed passes: a pass sends the rows through the triangular solves of the factors
so far, adds up their Gram matrix in the tasks, and the driver takes its Cholesky factor.
The first factor is shifted by Fukaya et al.'s bound, so it exists however badly
conditioned A is; two further passes make the rows orthonormal to double precision. The
factors compose to R with A = QR, and the singular values and right vectors of R are those
of A: the spectrum of the covariance is never read off a squared matrix. A matrix that is
rank deficient leaves a Gram matrix below the identity; its symmetric root goes in front
of R, so the rule is the same.

Sums are exact: per-dimension sums as decimals, deviations in whole numbers. A row is
centred by its exact whole-number distance to the floor of the mean, less the mean's
fraction. What travels is one Gram matrix a task (d x d doubles), added up in ``SLOTS``
groups; the driver gets ``SLOTS`` of them, whatever the number of rows. A vector that
makes up a third of all rows collapses in the tasks before the shuffle.

Defined results: rows whose vector is null or empty or holds a null or non-finite entry
are left out, as are rows whose length is not that of most distinct vectors (ties: the
longer one); repeated rows and null ids give a row each; a product beyond 64 bits
saturates, a deviation beyond them is null. Components whose singular value is not
above rounding error (``d * 2**-49`` of the largest) do not exist: a single distinct
vector, or an empty table, gives none and no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import written

SLOTS = 8
CHUNK_ENTRIES = 1 << 20
PASSES = 3  # one shifted, two plain
_UNIT = 2.0**-53


def _vectors(column: pa.Array, scale: float):
    """(row numbers, whole-number vectors) of the usable rows, one length at a time."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[sizes > 0]).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, CHUNK_ENTRIES // size)
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            entries = column.take(pa.array(own)).flatten().cast(pa.float64())
            values = entries.to_numpy(zero_copy_only=False).reshape(-1, size)  # a null entry reads as NaN
            usable = np.isfinite(values).all(axis=1)
            if usable.any():
                with np.errstate(over="ignore"):
                    x = np.floor(values[usable] * scale)
                low, high = x < -(2.0**63), x >= 2.0**63
                x = np.where(low | high, 0, x).astype(np.int64)
                x[low], x[high] = np.iinfo(np.int64).min, np.iinfo(np.int64).max
                yield own[usable], x


def _packed(scale: float):
    """Rows as (vec_id, length, the vector in integers of the narrowest of 2, 4 or 8
    bytes): equal vectors have equal bytes."""

    def run(batches):
        for batch in batches:
            for rows, x in _vectors(batch.column("embedding"), scale):
                widest = np.maximum(x.max(axis=1), ~x.min(axis=1))  # ~v = -v - 1 never overflows
                width = np.where(widest < 1 << 15, 2, np.where(widest < 1 << 31, 4, 8))
                for w in np.unique(width).tolist():
                    own = width == w
                    n, d = int(own.sum()), x.shape[1]
                    data = np.ascontiguousarray(x[own].astype(f"<i{w}"))
                    edges = pa.py_buffer(np.arange(0, (n + 1) * d * w, d * w, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("vec_id").take(pa.array(rows[own])), pa.array(np.full(n, d, np.int32)),
                         pa.Array.from_buffers(pa.binary(), n, [None, edges, pa.py_buffer(data)])],
                        names=["vec_id", "d", "x"])

    return run


def _matrices(batch: pa.RecordBatch, d: int):
    """(row numbers, whole-number matrix) of packed vectors of length ``d``, in chunks."""
    column = batch.column("x")
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    step = max(1, CHUNK_ENTRIES // d)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        for at in range(0, len(rows), step):
            own = rows[at : at + step]
            data = b"".join(column.take(pa.array(own)).to_pylist())
            yield own, np.frombuffer(data, f"<i{size // d}").reshape(-1, d).astype(np.int64)


@dataclass
class Whitening:
    """The mean of the distinct vectors as whole part and fraction, and the components:
    ``vectors[k]`` is a unit row, ``values[k]`` its eigenvalue, falling."""

    n: int
    sums: list[int]
    scale: float
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    trace: float = 0.0
    identity_error: float = 0.0

    @property
    def d(self) -> int:
        return len(self.sums)

    def __post_init__(self):
        parts = [divmod(s, self.n) for s in self.sums] if self.n else []
        self.whole = np.array([p[0] for p in parts], np.int64)
        self.rest = [p[1] for p in parts]
        self.part = np.array([float(Fraction(r, self.n)) for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in doubles."""
        far = (x > 1 << 62) | (x < -(1 << 62))
        if far.any():  # a difference may leave 64 bits
            return (x.astype(object) - self.whole.astype(object)).astype(np.float64) - self.part
        return (x - self.whole).astype(np.float64) - self.part

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n*x - S)**2 over the dimensions, exactly."""
        bound = self.n * (int(np.abs(self.centred(x)).max(initial=0)) + 2)
        if self.d * bound**2 < 1 << 62:
            t = self.n * (x - self.whole) - np.array(self.rest, np.int64)
            return (t * t).sum(axis=1).tolist()
        t = self.n * x.astype(object) - np.array(self.sums, object)
        return [v if v < 1 << 63 else None for v in (t * t).sum(axis=1).tolist()]

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values)[:, None]).T


def _solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Q of Q r = rows, column by column (``r`` upper triangular)."""
    q = np.empty_like(rows)
    for j in range(rows.shape[1]):
        q[:, j] = (rows[:, j] - q[:, :j] @ r[:j, j]) / r[j, j]
    return q


def _gram(points: DataFrame, size: int, d: int, rows_of) -> np.ndarray:
    """Sum of Yᵀ Y over all points, Y = ``rows_of`` a matrix of whole-number vectors."""

    def part(batches):
        from pyspark import TaskContext

        total = np.zeros((size, size))
        for batch in batches:
            for _, x in _matrices(batch, d):
                y = rows_of(x)
                total += y.T @ y
        slot = TaskContext.get().partitionId() % SLOTS
        yield pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([total.tobytes()], pa.binary())], names=["slot", "g"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, slot = np.zeros(size * size), 0
        for batch in batches:
            for s, g in zip(batch.column("slot").to_pylist(), batch.column("g").to_pylist()):
                total, slot = total + np.frombuffer(g), s
        yield pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([total.tobytes()], pa.binary())], names=["slot", "g"])

    schema = "slot bigint, g binary"
    # one row of a fixed size for each slot
    rows = points.mapInArrow(part, schema).groupBy("slot").applyInArrow(add, schema).collect()
    return sum((np.frombuffer(bytes(r.g)) for r in rows), np.zeros(size * size)).reshape(size, size)


def _sums(points: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of points and exact sum of every dimension."""

    def part(batches):
        low, high, n = np.zeros(d, np.int64), np.zeros(d, np.int64), 0
        for batch in batches:
            for _, x in _matrices(batch, d):
                low += (x & 0xFFFFFFFF).sum(axis=0)
                high += (x >> 32).sum(axis=0)
                n += len(x)
        columns = [np.arange(d), low, high, np.full(d, n)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["k", "low", "high", "n"])

    rows = points.mapInArrow(part, "k bigint, low bigint, high bigint, n bigint").groupBy("k").agg(
        F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum(F.col("high").cast("decimal(38,0)")).alias("high"),
        F.sum("n").alias("n")).orderBy("k").collect()  # one row a dimension
    return int(rows[0].n), [(int(r.high) << 32) + int(r.low) for r in rows]


def pack(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0) -> DataFrame:
    """Usable rows with their whole-number vector: ``vec_id``, ``d``, ``x``."""
    own = vectors.selectExpr(f"CAST(`{vec_id}` AS BIGINT) AS vec_id", f"CAST(`{embedding}` AS ARRAY<DOUBLE>) AS embedding")
    return own.mapInArrow(_packed(scale), "vec_id bigint, d int, x binary")


def fit(packed: DataFrame, *, components: int | None = None, scale: float = 256.0) -> Whitening:
    """Mean and leading ``components`` (all: None) of the distinct vectors of ``pack``."""
    points = written(packed.select("d", "x").distinct(), "whitening-points")
    size = points.groupBy("d").count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not size:
        return Whitening(0, [], scale)
    d = size[0].d
    points = points.where(f"d = {d}").select("x")
    n, sums = _sums(points, d)
    fitted = Whitening(n, sums, scale)

    factors: list[np.ndarray] = []

    def orthogonal(x: np.ndarray) -> np.ndarray:
        rows = fitted.centred(x)
        for r in factors:
            rows = _solve(rows, r)
        return rows

    composed = np.eye(d)
    for k in range(PASSES):
        g = _gram(points, d, d, orthogonal)
        size_of_rows = float(np.trace(g))
        if k == 0:
            fitted.trace = size_of_rows / n
            if size_of_rows == 0:
                return fitted
        shift = 11 * (n * d + d * (d + 1)) * _UNIT * size_of_rows
        try:
            r = np.linalg.cholesky(g + (shift if k == 0 else 0.0) * np.eye(d)).T
        except np.linalg.LinAlgError:  # rank deficient: shifted once more
            r = np.linalg.cholesky(g + shift * np.eye(d)).T
        factors.append(r)
        composed = r @ composed
    share, turn = np.linalg.eigh(_gram(points, d, d, orthogonal))  # of the orthogonal rows: the identity at full rank
    root = (turn * np.sqrt(np.maximum(share, 0))) @ turn.T
    _, spread, directions = np.linalg.svd(root @ composed)
    keep = int((spread > spread[0] * d * 2.0**-49).sum())
    keep = keep if components is None else min(keep, components)
    fitted.values, fitted.vectors = spread[:keep] ** 2 / n, directions[:keep]
    fitted.identity_error = float(np.abs(_gram(points, keep, d, fitted.project) / n - np.eye(keep)).max())
    return fitted


def whiten(packed: DataFrame, fitted: Whitening) -> DataFrame:
    """Every packed row of the fitted length: ``vec_id``, ``deviation`` and ``whitened``, its
    coordinates on the components in their order."""
    schema = "vec_id bigint, deviation bigint, whitened array<double>"
    keep, d = len(fitted.values), fitted.d

    def run(batches):
        for batch in batches:
            for rows, x in _matrices(batch, d):
                w = fitted.project(x)
                edges = pa.array(np.arange(0, (len(rows) + 1) * keep, keep, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows)), pa.array(fitted.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(edges, pa.array(np.ascontiguousarray(w).ravel()))],
                    names=["vec_id", "deviation", "whitened"])

    if not keep:
        return packed.limit(0).selectExpr("vec_id", "CAST(NULL AS BIGINT) AS deviation", "CAST(NULL AS ARRAY<DOUBLE>) AS whitened")
    return packed.where(f"d = {d}").mapInArrow(run, schema)
