"""Whitening of embeddings: pivoted Cholesky of the centred scatter, one-sided Jacobi on its factor.

Entries are put on a grid of whole numbers, so that counts, sums and deviations are exact. The fit is made
over the distinct vectors. Three passes over them take the sums, the scatter of what is left when the
mean is taken off, and the covariance of the whitened vectors. Each task adds up its own rows and
hands on a row for each entry of its sum; Spark adds those up by entry, so what reaches the driver is one
matrix, whatever the number of rows or tasks.

The scatter is factored as L L' with the largest remaining diagonal entry first, until nothing but
rounding is left. Rotations of pairs of columns then make the columns of L orthogonal, for all disjoint
pairs of a round at once. L L' stays what it is under them, so the squared norms of the columns are its
eigenvalues and the columns, normalised, its eigenvectors; those of small eigenvalues keep their digits.

Defined results: rows whose vector is NULL, or holds a NULL or an entry that is not finite, are left out, as
are vectors of another length than the most usual among the distinct ones (of equally usual ones,
the longest). Entries beyond what the grid holds are moved to its end. There are as many components
as there are directions in which the vectors vary by more than the rounding of the largest variance, at
most ``COMPONENTS``, so none for a single distinct vector.
A deviation beyond a long is NULL. Repeated rows are whitened as often as they come. Empty tables give
no rows. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import passing_tables, stored

COMPONENTS = 16
SCALE, ORIGIN = 64, 1_000_000
#: Largest whole number that an entry is moved to.
_BOUND = 1e17
_LONG = 2**63


# --- the grid --------------------------------------------------------------------


def gridded(vectors: DataFrame) -> DataFrame:
    """vec_id and x, the vector in whole numbers, of the usable rows."""
    vector = F.col("embedding")
    unusable = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))

    def whole(entry):
        scaled = entry.cast("double") * SCALE
        return F.floor(F.greatest(F.least(scaled, F.lit(_BOUND)), F.lit(-_BOUND))) + ORIGIN

    usable = vectors.select("vec_id", "embedding").where(vector.isNotNull() & ~unusable)
    return usable.select("vec_id", F.transform(vector, whole).alias("x"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: longs where they hold it, Python's own numbers otherwise."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if top * n + max(map(abs, sums)) < _LONG:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(off: np.ndarray) -> list[int | None]:
    """Sum of squares of each row, exactly, NULL beyond a long."""
    top = int(np.abs(off).max(initial=0))
    if off.dtype != object and top * top * off.shape[1] < _LONG:
        return (off * off).sum(axis=1).tolist()
    exact = [sum(int(v) ** 2 for v in row) for row in off.tolist()]
    return [d if d < _LONG else None for d in exact]


# --- sums over the rows ------------------------------------------------------------

_SUMS = T.StructType().add("i", "integer").add("j", "integer").add("value", "double")
_TOTALS = T.StructType().add("i", "integer").add("rows", "long").add("value", T.DecimalType(38, 0))


def totals(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of rows, and the exact sum of each dimension."""
    arrow = to_arrow_schema(_TOTALS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = 0, np.zeros(width, object)
        for batch in batches:
            x = _matrix(batch, width)
            count += len(x)
            top = int(np.abs(x).max(initial=0))
            sums += (x if top * len(x) < _LONG else x.astype(object)).sum(axis=0).astype(object)
        if count:
            columns = [range(width), [count] * width, sums.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow
            )

    parts = fit.select("x").mapInArrow(run, _TOTALS)
    rows = parts.groupBy("i").agg(F.sum("rows").alias("rows"), F.sum("value").alias("value")).collect()
    sums = {r["i"]: int(r["value"]) for r in rows}
    return rows[0]["rows"], [sums[i] for i in range(width)]


def _products(fit: DataFrame, width: int, centred) -> np.ndarray:
    """The sum over the rows of y y', y being centred(x) with a first entry of one."""
    arrow = to_arrow_schema(_SUMS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            y = centred(_matrix(batch, width))
            y = np.concatenate([np.ones((len(y), 1)), y], axis=1)
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            i, j = np.triu_indices(len(total))
            columns = [i.astype(np.int32), j.astype(np.int32), total[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow)

    parts = fit.select("x").mapInArrow(run, _SUMS)
    rows = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    i, j, value = (rows.column(c).to_numpy() for c in ("i", "j", "value"))
    matrix = np.zeros((int(j.max()) + 1,) * 2)
    matrix[i, j] = matrix[j, i] = value
    return matrix


# --- eigenvectors --------------------------------------------------------------------


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """L of full column rank and the order of rows, with matrix[order][:, order] = L L'."""
    size = len(matrix)
    order, left = np.arange(size), matrix.diagonal().copy()
    factor = np.zeros((size, size))
    least = np.finfo(float).eps * size * left.max(initial=0)
    for k in range(size):
        pivot = k + int(np.argmax(left[k:]))
        if left[pivot] <= least:
            return factor[:, :k], order
        for part in (order, left, factor):
            part[[k, pivot]] = part[[pivot, k]]
        root = np.sqrt(left[k])
        factor[k, k] = root
        below = matrix[order[k + 1 :], order[k]] - factor[k + 1 :, :k] @ factor[k, :k]
        factor[k + 1 :, k] = below / root
        left[k + 1 :] -= factor[k + 1 :, k] ** 2
    return factor, order


def _rounds(size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of columns once, in rounds of disjoint pairs: the first stays, the others go round."""
    even = size + size % 2
    ring = np.arange(1, even)
    for turn in range(even - 1):
        seats = np.concatenate([[0], np.roll(ring, turn)])
        one, two = seats[: even // 2], seats[even // 2 :][::-1]
        both = (one < size) & (two < size)
        yield one[both], two[both]


def orthogonal_columns(columns: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """The columns, rotated in pairs until all are orthogonal."""
    columns = columns.copy()
    close = np.finfo(float).eps * max(columns.shape[0], 1)
    for _ in range(sweeps):
        turned = False
        for one, two in _rounds(columns.shape[1]):
            p, q = columns[:, one], columns[:, two]
            pp, qq, pq = (p * p).sum(axis=0), (q * q).sum(axis=0), (p * q).sum(axis=0)
            open_ = np.abs(pq) > close * np.sqrt(pp * qq)
            if not open_.any():
                continue
            turned = True
            slope = (qq - pp) / np.where(open_, 2 * pq, 1)
            tangent = np.where(slope < 0, -1, 1) / (np.abs(slope) + np.hypot(1, slope))
            tangent = np.where(open_, tangent, 0)
            cosine = 1 / np.hypot(1, tangent)
            sine = cosine * tangent
            columns[:, one], columns[:, two] = cosine * p - sine * q, sine * p + cosine * q
        if not turned:
            break
    return columns


def eigen(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, of a scatter matrix."""
    factor, order = pivoted_cholesky(matrix)
    columns = orthogonal_columns(factor)
    norms = np.sqrt((columns * columns).sum(axis=0))
    falling = np.argsort(-norms, kind="stable")
    vectors = np.zeros((len(matrix), len(falling)))
    vectors[order] = columns[:, falling] / norms[falling]
    return norms[falling] ** 2, vectors


# --- fit and use -----------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What whitens a vector. Its size depends on the vectors' dimensions, not on their number."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float

    @property
    def width(self) -> int:
        return len(self.sums)

    def project(self, off: np.ndarray) -> np.ndarray:
        """Whitened rows of vectors given as n x - S."""
        return off.astype(float) / self.n @ (self.vectors / np.sqrt(self.values))


def fitted(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors; none if there is no vector."""
    spark = vectors.sparkSession
    with passing_tables(spark):
        fit = stored(spark, gridded(vectors).select("x").distinct(), "fit-list")
        usual = fit.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
        if usual is None or not usual["width"]:
            return None
        width = usual["width"]
        fit = fit.where(F.size("x") == width)
        n, sums = totals(fit, width)
        scatter = _products(fit, width, lambda x: off_mean(x, n, sums).astype(float) / n)[1:, 1:]
        values, axes = eigen(scatter)
        explained = values / scatter.trace() if len(values) else values
        values, axes, explained = values[:components] / n, axes[:, :components], explained[:components]
        made = Whitening(n, sums, axes, values, explained, 0.0)
        if len(values):
            white = _products(fit, width, lambda x: made.project(off_mean(x, n, sums))) / n
            covariance = white[1:, 1:] - np.outer(white[0, 1:], white[0, 1:])
            error = float(np.abs(covariance - np.eye(len(values))).max())
            made = Whitening(n, sums, axes, values, explained, error)
        return made


_WHITENED = (
    T.StructType()
    .add("component", "integer")
    .add("n", "long")
    .add("deviation", "long")
    .add("whitened", "double")
    .add("explained", "double")
    .add("identity_error", "double")
)


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and component."""
    model = fitted(vectors, components)
    rows = gridded(vectors)
    schema = T.StructType([rows.schema["vec_id"], *_WHITENED])
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    count = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, model.width)
            off = off_mean(x, model.n, model.sums)
            owner = np.repeat(np.arange(len(x)), count)
            columns = [
                np.tile(np.arange(1, count + 1, dtype=np.int32), len(x)),
                np.full(len(owner), model.n),
                pa.array(deviations(off), pa.int64()).take(pa.array(owner)),
                model.project(off).ravel(),
                np.tile(model.explained, len(x)),
                np.full(len(owner), model.identity_error),
            ]
            arrays = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(owner)), *arrays], schema=arrow)

    return rows.where(F.size("x") == model.width).mapInArrow(run, schema)
