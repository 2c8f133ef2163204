"""Embedding whitening on the leading principal components (operator 12).

Vectors become whole numbers (``floor(SCALE * entry)``), each distinct one is
fitted once. Tasks send the sums of their vectors, then, around the rounded
mean that every task is given, the products of the centred vectors: whole
numbers again, so the sums are exact in any order and what rounding the mean
left is taken off exactly. The driver holds matrices of the dimension of a
vector only. There the covariance is made tridiagonal by Householder
reflections, the leading eigenvalues are found by bisection on Sturm counts,
and the eigenvectors by inverse iteration, with reorthogonalisation where
eigenvalues lie close together. The components go to the tasks as a broadcast
(dimension x components numbers), which project every vector; a last sum over
the fitted vectors tells how far their covariance is from the identity.

Rows with a null vector, or one with null or non-finite entries, are left out,
and so are empty vectors and those that haven't the most common length (the
longest of the most common ones). Whole numbers are cut at +-2**61. A component
whose variance isn't above the rounding of the largest one is left out, so
fewer than two distinct vectors have none and give no rows. Rows that repeat,
and null ids, are kept as they are. ``deviation`` is null where it doesn't fit
a long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stage

SCALE = 256
COMPONENTS = 4
ROWS = 4096  # vectors of a task that are multiplied at once
_LIMB = 40  # bits of a sum that travel in one long
_LIMBS = "i int, j int, l0 long, l1 long, l2 long, l3 long"


# ---- symmetric eigenproblem, leading pairs -------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of a symmetric matrix: H ... a ... H is tridiagonal."""
    a = np.array(a, dtype=float)
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.abs(x).max()
        v = np.zeros(n - k - 1)
        if size > 0 and np.abs(x[1:]).max() > 0:
            v = x / size
            v[0] += np.copysign(np.sqrt(v @ v), v[0])
            v /= np.sqrt(v @ v)
            b = a[k + 1 :, k + 1 :]
            p = b @ v
            w = p - (v @ p) * v
            b -= 2 * (np.outer(v, w) + np.outer(w, v))
            x -= 2 * v * (v @ x)
            a[k, k + 1 :] = x
        reflectors.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def below(d: np.ndarray, e: np.ndarray, at: float, tiny: float) -> int:
    """Sturm count: the number of eigenvalues of the tridiagonal (d, e) below ``at``."""
    n, q = 0, 1.0
    for i, x in enumerate(d.tolist()):
        q = x - at - (e[i - 1] * e[i - 1] / q if i else 0.0)
        if abs(q) < tiny:
            q = -tiny
        n += q < 0
    return n


def leading(d: np.ndarray, e: np.ndarray, k: int) -> list[float]:
    """The k largest eigenvalues of a tridiagonal matrix, falling, by bisection to the last bit."""
    side = np.zeros(len(d) + 1)
    side[1:-1] = np.abs(e)
    low, high = float((d - side[:-1] - side[1:]).min()), float((d + side[:-1] + side[1:]).max())
    tiny = max(abs(low), abs(high)) * np.finfo(float).eps ** 2 + np.finfo(float).tiny
    out = []
    for i in range(len(d), len(d) - k, -1):
        a, b = low, high
        while True:
            mid = a + (b - a) / 2
            if not a < mid < b:
                break
            if below(d, e, mid, tiny) >= i:
                b = mid
            else:
                a = mid
        out.append(b)
    return out


def _solved(d: np.ndarray, e: np.ndarray, at: float, x: np.ndarray, tiny: float) -> np.ndarray:
    """(T - at)^-1 x by Gaussian elimination with row exchanges; a vanishing pivot is ``tiny``."""
    n = len(d)
    a, b, c = d - at, np.append(e, 0.0), np.zeros(n)  # a row: a[i], b[i], c[i] from its diagonal on
    x = x.copy()
    for i in range(n - 1):
        low = [e[i], d[i + 1] - at, e[i + 1] if i + 2 < n else 0.0]
        if abs(low[0]) > abs(a[i]):
            mine, a[i], b[i], c[i] = [a[i], b[i], c[i]], *low
            x[i], x[i + 1] = x[i + 1], x[i]
            low = mine
        if abs(a[i]) < tiny:
            a[i] = tiny
        f = low[0] / a[i]
        a[i + 1], b[i + 1], c[i + 1] = low[1] - f * b[i], low[2] - f * c[i], 0.0
        x[i + 1] -= f * x[i]
    if abs(a[-1]) < tiny:
        a[-1] = tiny
    for i in range(n - 1, -1, -1):
        x[i] = (x[i] - (b[i] * x[i + 1] if i + 1 < n else 0.0) - (c[i] * x[i + 2] if i + 2 < n else 0.0)) / a[i]
    return x


def eigenpairs(a: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as columns."""
    n = len(a)
    size = float(np.abs(a).max()) if n else 0.0
    if not size:
        return np.zeros(k), np.eye(n)[:, :k]
    d, e, reflectors = tridiagonal(a / size)
    values = leading(d, e, k)
    near = max(abs(values[0]), abs(values[-1]), 1e-300) * 1e-3  # eigenvalues of one cluster
    tiny = np.finfo(float).eps * np.abs(np.concatenate([d, e, [0.0]])).max() * 1e-2
    vectors = np.zeros((n, k))
    for i, value in enumerate(values):
        cluster = [j for j in range(i) if values[j] - value <= near]
        x = np.random.default_rng(i).normal(size=n)
        for _ in range(6):
            for _ in range(2):
                for j in cluster:
                    x -= (vectors[:, j] @ x) * vectors[:, j]
            x /= np.abs(x).max()
            x = _solved(d, e, value, x / np.sqrt(x @ x), tiny)
            x /= np.abs(x).max()
        for _ in range(2):
            for j in range(i):
                x -= (vectors[:, j] @ x) * vectors[:, j]
        vectors[:, i] = x / np.sqrt(x @ x)
    for at in range(len(reflectors) - 1, -1, -1):
        v = reflectors[at]
        vectors[at + 1 :] -= 2 * np.outer(v, v @ vectors[at + 1 :])
    for i in range(k):  # the same sign in every run
        vectors[:, i] *= np.copysign(1.0, vectors[np.abs(vectors[:, i]).argmax(), i])
    return np.array(values) * size, vectors


# ---- exact sums ---------------------------------------------------------------------------


def _limbs(total: int) -> list[int]:
    """A whole number in four longs whose sums can be added up apart."""
    sign, total = (-1, -total) if total < 0 else (1, total)
    mask = (1 << _LIMB) - 1
    return [sign * (total & mask), sign * (total >> _LIMB & mask), sign * (total >> 2 * _LIMB & mask), sign * (total >> 3 * _LIMB)]


def _total(row) -> int:
    return sum(int(row[f"l{k}"]) << (_LIMB * k) for k in range(4))


def products(x: np.ndarray) -> list[list[int]]:
    """x.T @ x of whole numbers, exactly: in doubles where no sum can pass 2**53, else in Python's integers."""
    most = int(np.abs(x).max()) if x.size else 0
    if most * most * len(x) < 1 << 53:
        y = x.astype(float)
        return (y.T @ y).astype(np.int64).tolist()
    y = x.astype(object)
    return (y.T @ y).tolist()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield _matrix(batch.slice(at, ROWS).column("x"), dim)


def _summed(fit: DataFrame, dim: int, of: Callable[[np.ndarray], dict]) -> dict[tuple[int, int], int]:
    """The sums over all vectors of the whole numbers that ``of`` gives by (i, j) for a block of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for x in _blocks(batches, dim):
            for k, v in of(x).items():
                total[k] = total.get(k, 0) + int(v)
        if total:
            rows = [(*k, *_limbs(v)) for k, v in total.items()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int32()] * 2 + [pa.int64()] * 4, strict=True)], ["i", "j", "l0", "l1", "l2", "l3"])

    sums = fit.select("x").mapInArrow(run, _LIMBS).groupBy("i", "j").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(4)])
    return {(r.i, r.j): _total(r) for r in sums.collect()}  # dimension x dimension numbers at most


def _column_sums(x: np.ndarray) -> dict:
    small = x.size == 0 or int(np.abs(x).max()) * len(x) < 1 << 62
    return {(-1, -1): len(x)} | {(int(i), -1): v for i, v in enumerate((x if small else x.astype(object)).sum(0).tolist())}


@dataclass(frozen=True)
class Whitener:
    """What ``fit`` learns: n and sums of the fitted vectors, components as columns, their variances, the whole variance."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """The whitened coordinates of whole-number vectors."""
        # Around the rounded mean first: a difference of whole numbers is exact.
        near = np.array([s // self.n for s in self.sums])
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return ((x - near) - rest) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)**2 of each vector; None where a long can't hold it."""
        most = max(map(abs, self.sums), default=0) + (int(np.abs(x).max()) if x.size else 0) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 63:
            y = x * self.n - np.array(self.sums)
            return (y * y).sum(1).tolist()
        y = x.astype(object) * self.n - np.array(self.sums, dtype=object)
        return [v if v < 1 << 63 else None for v in (y * y).sum(1).tolist()]


def whole(vectors: DataFrame, column: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x) of the rows that count, and their dimension."""
    v = F.col(column).cast("array<double>")
    sound = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.coalesce(sound, F.lit(False)) & (F.size("v") > 0))
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    most = float(1 << 61)
    x = F.transform("v", lambda c: F.floor(F.greatest(F.least(c * F.lit(float(SCALE)), F.lit(most)), F.lit(-most))).cast("long"))
    dim = sizes["dim"] if sizes else 0
    return rows.where(F.size("v") == dim).select("vec_id", x.alias("x")), dim


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener | None:
    """The whitener of the vectors ``x`` of a frame; None if they don't vary."""
    first = _summed(distinct, dim, _column_sums)
    n = first.pop((-1, -1), 0)
    if not n:
        return None
    sums = [first[i, -1] for i in range(dim)]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    shift = np.array(middle)

    def centred(x: np.ndarray) -> dict:
        y = x - shift
        m = products(y)
        return {(i, j): m[i][j] for i in range(dim) for j in range(i, dim)}

    second = _summed(distinct, dim, centred)
    rest = [s - n * m for s, m in zip(sums, middle, strict=True)]
    cov = np.zeros((dim, dim))
    exact = 0
    for (i, j), m in second.items():
        v = n * m - rest[i] * rest[j]  # n * n times the covariance, exactly
        cov[i, j] = cov[j, i] = v / (n * n)
        exact += v if i == j else 0
    values, vectors = eigenpairs(cov, min(components, dim))
    keep = values > max(values[0], 0) * dim * np.finfo(float).eps
    return Whitener(n, sums, vectors[:, keep], values[keep], exact / (n * n)) if keep.any() else None


def _identity_error(distinct: DataFrame, dim: int, model) -> float:
    """Largest absolute entry of the covariance of the fitted vectors' coordinates minus the identity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.value.values)
        total, mean = np.zeros((k, k)), np.zeros(k)
        for x in _blocks(batches, dim):
            y = model.value.project(x)
            total += y.T @ y
            mean += y.sum(0)
        rows = [(i, j, float(total[i, j])) for i in range(k) for j in range(i, k)] + [(i, -1, float(mean[i])) for i in range(k)]
        yield pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], schema=pa.schema([("i", pa.int32()), ("j", pa.int32()), ("v", pa.float64())]))

    sums = {(r.i, r.j): r.v for r in distinct.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()}
    n = model.value.n
    return max(abs(v / n - sums[i, -1] * sums[j, -1] / n / n - (i == j)) for (i, j), v in sums.items() if j >= 0)


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """A row for every vector that counts and every component (from 1, by falling variance)."""
    spark = vectors.sparkSession
    stage = Stage(spark, "whitening")
    rows, dim = whole(vectors, column)
    distinct = stage.write(rows.select("x").distinct(), "fit")
    found = fit(distinct, dim, components)
    if found is None:
        return spark.createDataFrame([], RESULT)
    model = spark.sparkContext.broadcast(found)
    error = _identity_error(distinct, dim, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        k = len(m.values)
        share = m.values / m.trace
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                x = _matrix(some.column("x"), dim)
                r = len(x)
                each = pa.array(np.repeat(np.arange(r), k))
                yield pa.record_batch(
                    [
                        some.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                        pa.array(np.full(r * k, m.n)), pa.array(m.deviations(x), pa.int64()).take(each),
                        pa.array(m.project(x).ravel()), pa.array(np.tile(share, r)), pa.array(np.full(r * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, RESULT)
