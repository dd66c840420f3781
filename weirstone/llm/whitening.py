"""Embedding whitening by a pivoted Cholesky factor and one-sided Jacobi rotations of it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: entries become floor(STEP * c) + OFFSET.
STEP, OFFSET, COMPONENTS = 64, 1_000_000, 32
# Tasks that sum up cells, at most: each sends one row for each cell of the scatter.
SUMMING_TASKS = 4_096
# The scatter and its factor are held by the driver, so vectors have a largest width.
WIDEST = 2_048
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


@dataclass(frozen=True)
class Moments:
    """Number of vectors, their sums per dimension, and the covariance (divisor n)."""

    n: int
    sums: tuple[int, ...]
    covariance: np.ndarray

    @property
    def centre(self) -> np.ndarray:
        """The whole numbers nearest to the means."""
        return np.array([(2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)

    @property
    def rest(self) -> list[int]:
        """n times what the centre misses of the mean, exact."""
        return [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the rows that take part.

    Those whose vector is there, without null or non-finite entries, and of the
    most frequent length (of equally frequent ones the longest): others have no
    covariance with it.
    """
    entry = F.transform("embedding", lambda c: c.cast("double"))
    rows = vectors.select("vec_id", entry.alias("embedding"))
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("embedding").isNotNull() & sound)
    lengths = rows.groupBy(F.size("embedding").alias("width")).agg(F.count(F.lit(1)).alias("rows"))
    row = lengths.agg(F.max(F.struct("rows", "width")).alias("top")).first()["top"]
    width = row["width"] if row else 0
    if width > WIDEST:
        raise ValueError(f"vectors of {width} entries: at most {WIDEST} are supported")
    return rows.where(F.size("embedding") == width)


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and whole-number vectors of each batch."""
    for batch in batches:
        if batch.num_rows:
            values = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            values = values.reshape(batch.num_rows, len(values) // batch.num_rows)
            scaled = np.floor(STEP * values)
            if np.abs(scaled).max(initial=0) >= 1 << 61:
                raise OverflowError("an entry does not fit a long")
            yield batch.column(0), scaled.astype(np.int64) + OFFSET


def _gram(z: np.ndarray) -> np.ndarray:
    """Products of whole-number columns, exact."""
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < _EXACT:
        f = z.astype(np.float64)
        return (f.T @ f).astype(np.int64)
    wide = z.astype(object)
    return wide.T @ wide


def _cells(totals: np.ndarray) -> pa.RecordBatch:
    cells = pa.array(np.arange(len(totals)), pa.int64())
    sums = pa.array([Decimal(int(t)) for t in totals], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([cells, sums], names=["cell", "total"])


def _summed(rows: DataFrame, sums: DataFrame) -> list[int]:
    """Totals by cell; as many rows as cells."""
    found = sums.groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    out = [0] * found.num_rows
    for cell, total in zip(found.column("cell").to_pylist(), found.column("total").to_pylist()):
        out[cell] = int(total)
    return out


def moments(rows: DataFrame) -> Moments | None:
    """Moments of rows as :func:`usable` gives them; null without rows.

    Two passes: sums first, then products of what is left after taking the
    rounded mean away. All of it is whole numbers, so neither the order of rows
    nor of tasks shows in the result; the part of the mean that rounding left
    is taken off at the end.
    """
    few = rows.coalesce(SUMMING_TASKS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches):
            part = np.r_[len(x), x.astype(object).sum(axis=0) if np.abs(x).max(initial=0) > 1 << 40 else x.sum(axis=0)]
            total = part.astype(object) if total is None else total + part
        if total is not None:
            yield _cells(total)

    found = _summed(rows, few.mapInArrow(sums, "cell long, total decimal(38,0)"))
    if not found:
        return None
    n, total = found[0], tuple(found[1:])
    width = len(total)
    plain = Moments(n, total, np.zeros((width, width)))
    centre = plain.centre
    upper = np.triu_indices(width)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _matrices(batches):
            part = _gram(x - centre)[upper].astype(object)
            total = part if total is None else total + part
        if total is not None:
            yield _cells(total)

    cells = _summed(rows, few.mapInArrow(products, "cell long, total decimal(38,0)"))
    covariance, rest = np.zeros((width, width)), plain.rest
    for i, j, cell in zip(*upper, cells):
        # Exact: n times the products less the products of what the rounded mean misses.
        covariance[i, j] = covariance[j, i] = (n * cell - rest[i] * rest[j]) / (n * n)
    return Moments(n, total, covariance)


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factor L and order p with ``matrix[p][:, p] = L @ L.T``; as many columns as the numerical rank."""
    left, width = matrix.astype(np.float64).copy(), len(matrix)
    order, factor = np.arange(width), np.zeros((width, width))
    least = np.finfo(float).eps * width * np.abs(np.diag(left)).max(initial=0)
    for k in range(width):
        at = k + int(np.argmax(np.diag(left)[k:]))
        if left[at, at] <= least:
            return factor[:, :k], order
        for rows in (order, factor):
            rows[[k, at]] = rows[[at, k]]
        left[[k, at]] = left[[at, k]]
        left[:, [k, at]] = left[:, [at, k]]
        factor[k, k] = np.sqrt(left[k, k])
        factor[k + 1 :, k] = left[k + 1 :, k] / factor[k, k]
        left[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return factor, order


def jacobi(factor: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """The columns of a factor, rotated until they are orthogonal.

    Each step rotates half as many disjoint pairs of columns as there are; a
    sweep meets every pair once.
    """
    width = factor.shape[1]
    rows = np.zeros((width + width % 2, len(factor)))  # columns as rows, one of zeros to make them even
    rows[:width] = factor.T
    half, close = len(rows) // 2, np.finfo(float).eps * np.sqrt(max(len(factor), 1))
    for _ in range(sweeps):
        turn, worst = list(range(len(rows))), 0.0
        for _ in range(len(rows) - 1):
            p, q = turn[:half], turn[half:][::-1]
            a, b = rows[p], rows[q]
            aa, bb, ab = (a * a).sum(1), (b * b).sum(1), (a * b).sum(1)
            scale = np.sqrt(aa * bb)
            angle = np.divide(np.abs(ab), scale, out=np.zeros(half), where=scale > 0)
            worst = max(worst, float(angle.max(initial=0)))
            move = angle > close
            zeta = np.divide(bb - aa, 2 * ab, out=np.zeros(half), where=move)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1, zeta))
            tangent = np.where(move, tangent, 0.0)[:, None]
            cosine = 1 / np.sqrt(1 + tangent * tangent)
            rows[p], rows[q] = cosine * (a - tangent * b), cosine * (b + tangent * a)
            turn = [turn[0], turn[-1], *turn[1:-1]]
        if worst <= close:
            break
    return rows[:width].T


def eigenpairs(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns); as many as the numerical rank."""
    factor, order = pivoted_cholesky(covariance)
    turned = jacobi(factor)
    lengths = np.sqrt((turned * turned).sum(axis=0))
    falling = np.argsort(-lengths, kind="stable")
    vectors = np.zeros_like(turned)
    vectors[order] = turned[:, falling] / lengths[falling]
    return lengths[falling] ** 2, vectors


def _deviations(z: np.ndarray, n: int, rest: list[int]) -> np.ndarray:
    """Exact sums of squares of ``n * z - rest`` by row."""
    bound = n * int(np.abs(z).max(initial=0)) + max(map(abs, rest), default=0)
    if bound * bound * z.shape[1] <= _LONG:
        y = n * z - np.array(rest, np.int64)
        return (y * y).sum(axis=1)
    y = n * z.astype(object) - np.array(rest, object)
    total = (y * y).sum(axis=1)
    if max(total, default=0) > _LONG:
        raise OverflowError("a deviation does not fit a long")
    return total.astype(np.int64)


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold null or non-finite entries take no part, nor
    do those of another length than most. Components of no variance (equal
    vectors, fewer vectors than dimensions) cannot be scaled and are left out,
    so one vector alone gives an empty result, as an empty table does. A row
    without an id keeps its null; repeated rows count each; other columns are
    not read. Entries or deviations beyond a long raise ``OverflowError``.
    """
    rows = usable(vectors)
    found = moments(rows)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None or not found.sums:
        return rows.sparkSession.createDataFrame([], schema)
    values, axes = eigenpairs(found.covariance)
    values, axes = values[:components], axes[:, :components]
    if not len(values):
        return rows.sparkSession.createDataFrame([], schema)
    n, centre, rest = found.n, found.centre, found.rest
    missed = np.array([r / n for r in rest])
    scaled = axes / np.sqrt(values)
    width = len(values)
    upper = np.triu_indices(width)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + len(upper[0]))
        for _, x in _matrices(batches):
            white = (x - centre - missed) @ scaled
            total += np.r_[white.sum(axis=0), (white.T @ white)[upper]]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["cell", "total"])

    sums = rows.coalesce(SUMMING_TASKS).mapInArrow(spread, "cell long, total double")
    cells = sums.groupBy("cell").agg(F.sum("total").alias("total")).orderBy("cell").toArrow().column("total").to_numpy()
    means = cells[:width] / n
    spreads = cells[width:] / n - means[upper[0]] * means[upper[1]]
    error = float(np.abs(spreads - (upper[0] == upper[1])).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _matrices(batches):
            z = x - centre
            white = pa.array(((z - missed) @ scaled).ravel())
            starts = pa.array(np.arange(0, len(z) * width + 1, width, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(_deviations(z, n, rest)), pa.ListArray.from_arrays(starts, white)],
                names=["vec_id", "deviation", "white"],
            )

    share = F.array(*[F.lit(float(v / np.trace(found.covariance))) for v in values])
    white = rows.mapInArrow(project, "vec_id long, deviation long, white array<double>")
    return white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
