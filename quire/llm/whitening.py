"""Embedding whitening: principal components of all vectors, to double precision, and every vector on them at unit variance.

The covariance is distributed and exact: entries become integers on a grid (``x = floor(64 * c) + 1000000``), every task
sums ``y = x - q`` and ``y y'`` for the integer part ``q`` of the mean, and the sums of integers are put together as
integers. Only ``d`` sums and ``d * d`` products of a vector length ``d`` reach the driver, whatever the number of rows.

The eigenvectors come by mixed-precision refinement: those of the covariance in float32 are a start that iterations of
matrix products in extended precision correct (Ogita and Aishima, quadratic convergence). Eigenvalues that an iteration
cannot tell apart yet form a cluster; a sub-solve of the small matrix that the cluster's vectors span turns them inside
their space, whose spread is small, so that the next iteration tells them apart.

Defined cases: a vector that is null or holds null or non-finite entries is left out; so is an empty one, as it has no
component. Vectors of different lengths are whitened apart, each length as a table of its own. A component without
variance (fewer rows than dimensions, equal vectors, one row) has null ``whitened`` and ``explained`` 0, and does not
count for ``identity_error``; a table in which no component has variance has 0 there. Repeated rows count as often as
they occur and all come back; ids may be null or repeat; equal eigenvalues take any basis of their space, the same for
all rows; an empty table gives no rows. Other columns are not looked at; names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
ROWS_AT_ONCE = 8192
EXACT = 2**53  # doubles hold integers below it without error
ITERATIONS = 40

Wide = np.longdouble


# ---------------------------------------------------------------- eigenvectors by refinement


def refined(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns) of a symmetric matrix, in the precision of ``np.longdouble``."""
    a = matrix.astype(Wide)
    size = np.abs(a).max() if a.size else Wide(0)
    if size == 0:
        return np.zeros(len(a), Wide), np.eye(len(a), dtype=Wide)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(Wide)
    eye, tiny = np.eye(len(a), dtype=Wide), np.finfo(Wide).eps * len(a)
    for _ in range(ITERATIONS):
        r = eye - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        gap = 2 * (np.linalg.norm((s - np.diag(values)).astype(np.float64)) + np.linalg.norm(r.astype(np.float64)))
        apart = values[None, :] - values[:, None]
        told = np.abs(apart) > gap
        step = np.where(told, (s + values[None, :] * r) / np.where(told, apart, 1), r / 2)
        x = x + x @ step
        for own in clusters(values, gap):
            x[:, own] = x[:, own] @ turned(x[:, own], a)
        if np.abs(step).max() <= tiny:
            break
    for _ in range(2):  # rotations by rounding noise of nearly equal values leave x orthogonal to first order only
        x = x + x @ (eye - x.T @ x) / 2
    values = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, x[:, order] / np.sqrt(np.diag(x.T @ x)[order])


def clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues of which each is within ``gap`` of the next."""
    order = np.argsort(values, kind="stable")
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [part for part in np.split(order, cuts) if len(part) > 1]


def turned(vectors: np.ndarray, a: np.ndarray) -> np.ndarray:
    """The rotation of a cluster's vectors that makes them eigenvectors within the space they span."""
    inner = vectors.T @ a @ vectors
    inner = inner - np.eye(len(inner), dtype=Wide) * (np.trace(inner) / len(inner))
    inner = (inner + inner.T) / 2
    spread = np.abs(inner).max()
    if spread <= np.finfo(Wide).eps:  # one eigenvalue as far as can be known: any basis will do
        return np.eye(len(inner), dtype=Wide)
    w = np.linalg.eigh((inner / spread).astype(np.float64))[1].astype(Wide)
    return w @ (np.eye(len(w), dtype=Wide) + (np.eye(len(w), dtype=Wide) - w.T @ w) / 2)


# ---------------------------------------------------------------- sums over rows


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """Length, ids and grid values (doubles holding integers) of at most ``ROWS_AT_ONCE`` vectors at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(lo, ROWS_AT_ONCE)
            ids, vectors = part.column(0), part.column(1)
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for d in np.unique(sizes).tolist():
                rows = pa.array(np.flatnonzero(sizes == d))
                yield d, ids.take(rows), np.floor(SCALE * _matrix(vectors.take(rows))) + SHIFT


def _integers(x: np.ndarray) -> np.ndarray:
    """Integers of any size, so that sums are exact."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def total(x: np.ndarray) -> np.ndarray:
    """Exact column sums of doubles that hold integers."""
    if np.abs(x).max() * len(x) < EXACT:
        return _integers(x.sum(axis=0))
    return _integers(x).sum(axis=0)


def products(y: np.ndarray) -> np.ndarray:
    """Exact ``y'y`` of doubles that hold integers."""
    if np.abs(y).max() ** 2 * len(y) < EXACT:
        return _integers(y.T @ y)
    y = _integers(y)
    return y.T.dot(y)


def _summed(rows: DataFrame, sums: Callable[[int, np.ndarray], list[np.ndarray]], exact: bool) -> dict[int, list]:
    """Sums of the arrays that ``sums`` makes of each block, by vector length.

    Each task sends one row for each entry that it summed; Spark adds them. The result has the entries of one
    such array for each length, so it is bounded by the square of the vector length.
    """
    kind = "decimal(38,0)" if exact else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for d, _, x in _blocks(batches):
            new = sums(d, x)
            held[d] = [h + n for h, n in zip(held[d], new)] if d in held else new
        for d, arrays in held.items():
            for which, values in enumerate(arrays):
                flat = np.asarray(values).ravel()
                value = pa.array([str(v) for v in flat]) if exact else pa.array(flat.astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d] * len(flat), pa.int32()), pa.array([which] * len(flat), pa.int32()),
                     pa.array(np.arange(len(flat))), value], ["d", "which", "at", "value"])

    sent = rows.mapInArrow(run, f"d int, which int, at long, value {'string' if exact else 'double'}")
    added = sent.groupBy("d", "which", "at").agg(F.sum(F.col("value").cast(kind)).alias("value"))
    found: dict[int, dict[int, list]] = {}
    for r in added.orderBy("d", "which", "at").collect():
        found.setdefault(r["d"], {}).setdefault(r["which"], []).append(int(r["value"]) if exact else r["value"])
    return {d: [own[k] for k in sorted(own)] for d, own in found.items()}


# ---------------------------------------------------------------- the fitted transform


@dataclass
class Fit:
    """What whitens vectors of one length."""

    n: int
    sums: list[int]  # of the grid values, by dimension
    vectors: np.ndarray  # components as columns
    values: np.ndarray  # their eigenvalues
    explained: np.ndarray
    usable: np.ndarray  # components with variance

    @property
    def centre(self) -> np.ndarray:
        """Integer part of the mean."""
        return np.array([s // self.n for s in self.sums], np.float64)

    @property
    def rest(self) -> list[int]:
        """``n`` times what the mean has beyond its integer part."""
        return [s % self.n for s in self.sums]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """Grid values on the components, at unit variance; NaN where a component has none."""
        mean = np.array([r / self.n for r in self.rest])
        out = (x - self.centre - mean) @ self.vectors
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.where(self.usable, out / np.sqrt(np.where(self.usable, self.values, 1)), np.nan)

    def deviation(self, x: np.ndarray) -> np.ndarray:
        """Sum over dimensions of ``(n x - S)^2``, exact."""
        y = x - self.centre
        most = int(np.abs(y).max(initial=0)) + 1
        if (self.n * most) ** 2 * max(1, x.shape[1]) < 2**63:
            out = self.n * y.astype(np.int64) - np.array(self.rest, np.int64)
            return (out * out).sum(axis=1)
        out = self.n * _integers(y) - np.array(self.rest, object)
        return (out * out).sum(axis=1)


def covariance(n: int, sums: list[int], moments: list[int]) -> np.ndarray:
    """From exact integer sums: the covariance with divisor ``n`` of centred values, rounded once."""
    rest = np.array([s % n for s in sums], object)
    d = len(sums)
    top = n * np.array(moments, object).reshape(d, d) - rest[:, None] * rest[None, :]
    whole, left = top // (n * n), top % (n * n)
    wide = np.vectorize(lambda v: Wide(str(v)), otypes=[Wide])
    return wide(whole) + wide(left) / Wide(str(n * n))


def fit(rows: DataFrame, components: int) -> dict[int, Fit]:
    """One :class:`Fit` for each vector length. Two passes: the mean, then products about its integer part."""
    first = _summed(rows, lambda d, x: [np.array([len(x)], object), total(x)], exact=True)
    centres = {d: np.array([s // n for s in sums], np.float64) for d, ((n,), sums) in first.items()}
    second = _summed(rows, lambda d, x: [products(x - centres[d])], exact=True)
    out = {}
    for d, ((n,), sums) in first.items():
        v = covariance(n, sums, second[d][0])
        values, vectors = refined(v)
        whole = np.trace(v)
        usable = (values > np.finfo(np.float64).eps * d * max(values[0], 0)) & (values > 0)
        explained = np.where(usable, values / whole, 0) if whole > 0 else np.zeros(d)
        k = min(components, d)
        out[d] = Fit(n, sums, vectors[:, :k].astype(np.float64), values[:k].astype(np.float64),
                     explained[:k].astype(np.float64), usable[:k])
    return out


def identity_errors(rows: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all of them."""

    def sums(d: int, x: np.ndarray) -> list[np.ndarray]:
        w = fits[d].whiten(x)[:, fits[d].usable]
        return [w.sum(axis=0), w.T @ w]

    out = {d: 0.0 for d in fits}
    for d, found in _summed(rows, sums, exact=False).items():
        if len(found) == 2:
            mean = np.array(found[0]) / fits[d].n
            second = np.array(found[1]).reshape(len(mean), -1) / fits[d].n
            out[d] = float(np.abs(second - np.outer(mean, mean) - np.eye(len(mean))).max())
    return out


_OUT = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_column: str = "vec_id",
           vector_column: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every valid row and component."""
    vector = F.col(vector_column)
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vector.cast("array<double>").alias("vector"))
    rows = rows.filter(F.coalesce((F.size(vector) > 0) & good, F.lit(False)))
    fits = fit(rows, components)
    errors = identity_errors(rows, fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, ids, x in _blocks(batches):
            own = fits[d]
            k, w = len(own.values), own.whiten(x)
            far = own.deviation(x)
            far = pa.array(far, pa.int64()) if far.dtype != object else pa.array([str(v) for v in far])
            at = pa.array(np.repeat(np.arange(len(x)), k))
            same = lambda v, kind: pa.array(np.full(len(at), v), kind)
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), same(own.n, pa.int64()),
                 far.take(at).cast(pa.decimal128(38, 0)), pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                 pa.array(np.tile(own.explained, len(x))), same(errors[d], pa.float64())],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, _OUT)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings`` on the 32 strongest components. A deviation beyond a long is an error."""
    return whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").cast("long"))


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
SQL: dict[str, str] = {}  # eigenvectors are beyond SQL; tested against a plain eigensolver
