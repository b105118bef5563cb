"""Whitening of embeddings: principal components by FEAST, from a covariance that Spark adds up.

Entries become whole numbers ``x = floor(scale * c) + shift``, so counts and sums are exact and a deviation from the
mean is ``(n x - S) / n`` with an exact numerator. Tasks add up ``d x d`` products of centred rows, and the matrix,
whose size does not depend on the rows, is all that reaches the driver.

Its eigenvalues are counted by inertia: the negative pivots of ``V - s I``, read off a tridiagonal form, say how many
lie below ``s``. Bisection on these counts finds intervals that hold the wanted eigenvalues, a few in each. Each
interval is one task: FEAST puts a circle round it, adds up solutions of ``(z I - V) X = Y`` over quadrature points
``z`` of the circle, which is a projection onto the eigenvectors inside, extracts them by Rayleigh-Ritz, and repeats
until they stand still. A task that found another number of them than the inertia counts is an error.

Defined results: vectors that are NULL, empty, shorter than the longest one, or hold a NULL, NaN or infinite entry
have no rows. Components without variance (to rounding) cannot be whitened and are left out, so one vector, or equal
ones, have none. Repeated rows count as often as they stand there; NULL ids are kept; other columns are not looked at.
Entries whose ``x``, or deviations whose value, do not fit a 64-bit integer raise an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ringspan.llm.common import small_batches
from ringspan.llm.scratch import PARTS, array_parts, combine_arrays

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32

# Eigenvalues one interval should hold, and quadrature points on the upper half of its circle.
PER_INTERVAL = 6
POINTS = 8
# Rounds after which FEAST gives up, and the residual (to the largest eigenvalue) at which it has arrived.
ROUNDS = 60
RESIDUAL = 1e-13
# Eigenvalues below this share of the largest are rounding.
RANK = 1e-12


# --- rows ----------------------------------------------------------------------------------------------------


def _vectors(embeddings: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector array<double>`` of the rows that hold finite entries only."""
    rows = embeddings.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)


def _integers(batch: pa.RecordBatch, dim: int, scale: int, shift: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows of ``dim`` entries, and their entries as whole numbers."""
    lists = batch.column("vector")
    whole = pa.array(np.diff(lists.offsets.to_numpy()) == dim)
    batch = batch.filter(whole)
    values = batch.column("vector").flatten().to_numpy().reshape(-1, dim)
    scaled = np.floor(scale * values)
    if scaled.size and np.abs(scaled).max() >= 2.0**52:
        raise ArithmeticError("an entry is too large to become a 64-bit integer")
    return batch, scaled.astype(np.int64) + shift


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``n`` rows with sums ``sums``, their covariance's trace, and the components as columns."""

    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    components: np.ndarray
    scale: int = SCALE
    shift: int = SHIFT

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``x - S / n``: the whole part of the mean is taken off exactly, the rest is below one."""
        return x - self.sums // self.n - self.sums % self.n / self.n

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``sum (n x - S)^2`` over the dimensions, exact."""
        if not len(x):
            return np.zeros(0, np.int64)
        # x - S // n is small; the product is taken in Python's integers only where 64 bits might not do.
        small = x - self.sums // self.n
        reach = (int(np.abs(small).max()) + 1) * self.n
        if x.shape[1] * reach * reach < 2**63:
            return np.square(self.n * small - self.sums % self.n).sum(axis=1)
        wide = small.astype(object) * self.n - (self.sums % self.n).astype(object)
        sums = (wide * wide).sum(axis=1)
        if max(sums) >= 2**63:
            raise ArithmeticError("a deviation does not fit a 64-bit integer")
        return sums.astype(np.int64)


def _sums(rows: DataFrame, dim: int, scale: int, shift: int) -> tuple[int, np.ndarray]:
    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dim + 1, np.int64)
        for batch in small_batches(batches):
            _, x = _integers(batch, dim, scale, shift)
            total[0] += len(x)
            total[1:] += x.sum(axis=0)
        yield array_parts(total, 1)

    total = combine_arrays(rows.mapInArrow(add, PARTS), dim + 1, 1, "i8", np.add)
    return int(total[0]), total[1:]


def _products(rows: DataFrame, dim: int, width: int, model: Whitening, take) -> np.ndarray:
    """The sum over rows of the outer products of ``take(x)``, ``width`` numbers, over ``n``."""
    parts = 1
    while width * width // parts > 1 << 16 and width % (2 * parts) == 0:
        parts *= 2

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in small_batches(batches):
            centred = take(_integers(batch, dim, model.scale, model.shift)[1])
            total += centred.T @ centred
        yield array_parts(total, parts)

    whole = combine_arrays(rows.mapInArrow(add, PARTS), width * width, parts, "f8", np.add)
    return whole.reshape(width, width) / model.n


# --- eigenvalues by inertia ----------------------------------------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a similar tridiagonal matrix, by Householder reflections."""
    a = matrix.copy()
    for k in range(len(a) - 2):
        v = a[k + 1 :, k].copy()
        norm = np.linalg.norm(v)
        if norm == 0:
            continue
        v[0] += np.copysign(norm, v[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_below(diagonal: np.ndarray, beside: np.ndarray, at: float) -> int:
    """Eigenvalues below ``at``: the negative pivots of the factorisation of the shifted matrix."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = 0, 1.0
    for entry, off in zip(diagonal.tolist(), [0.0, *beside.tolist()]):
        pivot = entry - at - off * off / pivot
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def intervals_of(matrix: np.ndarray, most: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Intervals ``(low, high, count)``, from the top, that hold the ``most`` largest positive eigenvalues.

    Borders are put in the widest gap near the wanted count, so that the circle round an interval keeps away
    from the eigenvalues of the next. Equal eigenvalues stay together and may make an interval larger.
    """
    diagonal, beside = tridiagonal(matrix)
    padded = np.abs(np.concatenate([[0.0], beside, [0.0]]))
    top = float((diagonal + padded[:-1] + padded[1:]).max())
    if not top > 0:
        return []
    floor, size = top * RANK, len(matrix)
    top *= 1 + 1e-9

    def above(at: float) -> int:
        return size - count_below(diagonal, beside, at)

    def largest(rank: int) -> float:
        """The eigenvalue of that rank from the top, by bisection on the counts."""
        low, high = floor, top
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if above(middle) >= rank else (low, middle)
        return low

    positive = above(floor)
    if not positive:
        return []
    wanted = min(most, positive)

    def is_open(rank: int) -> bool:
        """Whether the eigenvalue after that rank is another one, and not the same up to rounding."""
        return values[rank - 1] - values[rank] > 1e-6 * values[rank - 1]

    values: list[float] = []
    while len(values) < wanted + 1 or not is_open(len(values) - 1):
        rank = len(values) + 1
        values.append(largest(rank) if rank <= positive else 0.0)
    found, done, high, end = [], 0, top, len(values) - 1
    while done < end:
        near = range(done + max(1, per_interval // 2), min(done + per_interval, end) + 1)
        borders = [rank for rank in near if is_open(rank)]
        if end - done <= per_interval:
            border = end
        elif borders:
            border = max(borders, key=lambda rank: 1 - values[rank] / values[rank - 1])
        else:
            border = next(rank for rank in range(done + 1, end + 1) if is_open(rank))
        low = max((values[border - 1] + values[border]) / 2, floor)
        found.append((low, high, above(low) - done))
        done, high = border, low
    return found


# --- FEAST ---------------------------------------------------------------------------------------------------


def feast(matrix: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues in ``[low, high]`` and their unit eigenvectors as columns.

    The circle has the interval as diameter. Real symmetry leaves the upper half of it: Gauss-Legendre points
    at angles ``pi (1 + t) / 2``.
    """
    size = len(matrix)
    centre, radius = (low + high) / 2, (high - low) / 2
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi * (1 + nodes) / 2
    points = centre + radius * np.exp(1j * angles)
    width = min(size, count + max(4, count // 2))
    basis = np.random.default_rng(size + count).standard_normal((size, width))
    scale = np.abs(matrix).sum(axis=1).max()
    identity = np.eye(size)
    for _ in range(ROUNDS):
        projected = np.zeros((size, width))
        for angle, weight, z in zip(angles, weights, points):
            solved = np.linalg.solve(z * identity - matrix, basis)
            projected += weight / 2 * (radius * np.exp(1j * angle) * solved).real
        q, _ = np.linalg.qr(projected)
        ritz, rotation = np.linalg.eigh(q.T @ matrix @ q)
        basis = q @ rotation
        # The basis is wider than the interval needs; a value that only a mixture of outer vectors puts inside has a
        # large residual.
        residual = np.linalg.norm(matrix @ basis - basis * ritz, axis=0)
        arrived = (ritz >= low) & (ritz <= high) & (residual <= RESIDUAL * scale)
        values, vectors = ritz[arrived], basis[:, arrived]
        if len(values) == count:
            return values, vectors
    raise ArithmeticError(f"{len(values)} eigenvalues found in [{low}, {high}], inertia counts {count}")


def _eigenpairs(spark, matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues, falling, and their vectors; one task per interval."""
    intervals = intervals_of(matrix, most)
    if not intervals:
        return np.zeros(0), np.zeros((len(matrix), 0))

    def solve(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(batch.column(c).to_pylist() for c in ("low", "high", "count"))):
                values, vectors = feast(matrix, low, high, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))], names=["value", "vector"]
                )

    rows = spark.createDataFrame(intervals, "low double, high double, count long").repartition(len(intervals), "low")
    found = rows.mapInArrow(solve, "value double, vector array<double>").collect()
    # Neighbours across a border: one more Rayleigh-Ritz over all of them makes the vectors orthogonal.
    q, _ = np.linalg.qr(np.array([row["vector"] for row in found]).T)
    values, rotation = np.linalg.eigh(q.T @ matrix @ q)
    falling = np.argsort(values)[::-1][:most]
    return values[falling], (q @ rotation)[:, falling]


# --- the operator --------------------------------------------------------------------------------------------


def fit_whitening(
    embeddings: DataFrame,
    components: int = COMPONENTS,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
    shift: int = SHIFT,
) -> Whitening | None:
    """The model of all rows with finite entries; None if there are none. Three passes: size, sums, products."""
    rows = _vectors(embeddings, id_col, vector_col)
    dim = rows.agg(F.max(F.size("vector"))).first()[0]
    if dim is None:
        return None
    n, sums = _sums(rows, dim, scale, shift)
    model = Whitening(n, sums, 0.0, np.zeros(0), np.zeros((dim, 0)), scale, shift)
    covariance = _products(rows, dim, dim, model, model.centred)
    covariance = (covariance + covariance.T) / 2
    values, vectors = _eigenpairs(embeddings.sparkSession, covariance, min(components, dim))
    return Whitening(n, sums, float(np.trace(covariance)), values, vectors, scale, shift)


def identity_error(embeddings: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The largest entry of the whitened rows' covariance minus the identity. Whitened rows have mean zero, as
    they are made of deviations from the mean."""
    width = len(model.values)
    if not width:
        return 0.0
    rows = _vectors(embeddings, id_col, vector_col)
    products = _products(rows, len(model.sums), width, model, model.whiten)
    return float(np.abs(products - np.eye(width)).max())


WHITENED = "vec_id long, n long, deviation long, whitened array<double>"


def whiten(embeddings: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n, deviation, whitened``, one number per component, for the rows the model was fitted on or
    others of their length."""

    def apply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            batch, x = _integers(batch, len(model.sums), model.scale, model.shift)
            white = model.whiten(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").cast(pa.int64()),
                    pa.array(np.full(len(x), model.n)),
                    pa.array(model.deviations(x)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(white).reshape(-1))),
                ],
                names=["vec_id", "n", "deviation", "whitened"],
            )

    return _vectors(embeddings, id_col, vector_col).mapInArrow(apply, WHITENED)


def whitening_report(embeddings: DataFrame) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``, a row per vector and component."""
    model = fit_whitening(embeddings)
    if model is None:  # no row passes, so none is looked at
        one = np.ones(1, np.int64)
        model = Whitening(1, one, 1.0, np.zeros(0), np.zeros((1, 0)))
    error = identity_error(embeddings, model)
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    return (
        whiten(embeddings, model)
        .select("vec_id", "n", "deviation", F.posexplode("whitened").alias("at", "whitened"))
        .select(
            "vec_id",
            (F.col("at") + 1).alias("component"),
            "n",
            "deviation",
            "whitened",
            F.get(shares, F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
