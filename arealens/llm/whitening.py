"""Whitening of embeddings by polarisation.

Entries become integers. For every dimension and every sum of two dimensions the squares of the centred values
are added up exactly; half the difference ``V(a + b) - V(a) - V(b)`` is the covariance of a and b. Tasks hold
only these sums, one per dimension and pair; they are added by Spark as decimals, and the assembled matrix is
decomposed on the driver (its size is set by the number of dimensions alone).

Centring is exact too: values are taken from the integer next to their mean, and the rest of the mean, a
fraction with denominator n, is carried in whole numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Entries whose scaled value reaches this count as not finite: beyond it sums over 10^12 rows would not fit a decimal.
LARGEST = 1 << 40
#: Components whose share of the largest eigenvalue is below this have no direction of their own.
RANK = 1e-13
_ROWS = 4096


class Whitening(NamedTuple):
    """n vectors, their integer sums per dimension, all eigenvalues and the unit eigenvectors (columns) by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray


def _whole(column: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integer matrix) of the usable vectors of a list column, for each length or for one."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    for length in np.unique(lengths) if size is None else [size]:
        rows = np.flatnonzero(lengths == length) if length > 0 else []
        for lo in range(0, len(rows), _ROWS):
            some = rows[lo : lo + _ROWS]
            flat = column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)  # null entries become nan
            scaled = np.floor(SCALE * flat.reshape(len(some), int(length)))
            good = (np.abs(scaled) < LARGEST).all(axis=1)
            yield some[good], scaled[good].astype(np.int64) + SHIFT


def _per_task(values: Callable, column: str, schema: str):
    """A mapInArrow function that adds up ``values(matrix) -> {key: array}`` over a task and returns it as rows."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict = {}
        for batch in batches:
            for matrix in values(batch.column(column)):
                for key, found in matrix.items():
                    totals[key] = totals[key] + found if key in totals else found
        for key, found in totals.items():
            for lo in range(0, len(found), 65536):
                part = found[lo : lo + 65536]
                value = pa.array([str(v) for v in part]) if found.dtype == object else pa.array(part)
                columns = [pa.array([key] * len(part), pa.int64()), pa.array(range(lo, lo + len(part)), pa.int64()), value]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _length_sums(column: pa.Array) -> Iterator[dict[int, np.ndarray]]:
    for rows, x in _whole(column):
        if len(rows):
            yield {x.shape[1]: np.concatenate([[len(rows)], x.sum(axis=0)]).astype(object)}


def _square_sums(middle: np.ndarray):
    """Per dimension a: the squares of the centred values of a, then of the sums of a and each later dimension."""

    def run(column: pa.Array) -> Iterator[dict[int, np.ndarray]]:
        for rows, x in _whole(column, len(middle)):
            if not len(rows):
                continue
            z = x - middle
            # four times the square of the largest entry, once a row, must fit an integer of 64 bits
            exact = 4 * int(np.abs(z).max()) ** 2 * len(z) < 1 << 62
            columns = np.ascontiguousarray((z if exact else z.astype(object)).T)
            for a in range(len(middle)):
                both = columns[a] + columns[a:]
                both[0] = columns[a]
                yield {a: (both * both).sum(axis=1).astype(object)}

    return run


def _total(docs: DataFrame, run) -> dict[int, dict[int, int]]:
    schema = "key long, at long, value string"
    parts = docs.mapInArrow(run, schema).groupBy("key", "at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    out: dict[int, dict[int, int]] = {}
    for row in parts.collect():  # one row per dimension or pair of dimensions
        out.setdefault(row["key"], {})[row["at"]] = int(row["value"])
    return out


def fit_whitening(vectors: DataFrame) -> Whitening | None:
    """The whitening of ``vectors`` (embedding), None where no vector is usable.

    Vectors that are null, empty, or hold null or non-finite entries are left out, as are those of another
    length than the most common one (of equally common lengths the largest).
    """
    column = vectors.select("embedding")
    found = _total(column, _per_task(_length_sums, "embedding", "key long, at long, value string"))
    if not found:
        return None
    size = max(found, key=lambda length: (found[length][0], length))
    n, sums = found[size][0], [found[size][a + 1] for a in range(size)]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    squares = _total(column, _per_task(_square_sums(np.array(middle, np.int64)), "embedding", "key long, at long, value string"))
    rest = [s - n * m for s, m in zip(sums, middle)]  # n times what is left of the mean
    # n^2 times each variance, exact: the sum of squares around the mean is that around the middle less rest^2 / n
    own = [n * squares[a][0] - rest[a] ** 2 for a in range(size)]
    covariance = np.empty((size, size))
    for a in range(size):
        covariance[a, a] = own[a] / n**2
        for b in range(a + 1, size):
            both = n * squares[a][b - a] - (rest[a] + rest[b]) ** 2
            covariance[a, b] = covariance[b, a] = (both - own[a] - own[b]) / (2 * n**2)
    values, directions = np.linalg.eigh(covariance)
    return Whitening(n, tuple(sums), np.maximum(values[::-1], 0), np.ascontiguousarray(directions[:, ::-1]))


class _Projection:
    """Whitened values of a matrix of integers; directions without variance give nan."""

    def __init__(self, fit: Whitening, components: int):
        size = len(fit.sums)
        k = min(components, size)
        self.middle = np.array([(2 * s + fit.n) // (2 * fit.n) for s in fit.sums], np.int64)
        self.rest = np.array([(s - fit.n * int(m)) / fit.n for s, m in zip(fit.sums, self.middle)])
        self.real = (fit.values[:k] > RANK * fit.values[0]) & (fit.values[:k] > 0)
        self.directions = np.where(self.real, fit.vectors[:, :k] / np.sqrt(np.where(self.real, fit.values[:k], 1)), np.nan)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.middle) - self.rest) @ self.directions


def _product_sums(project: _Projection):
    def run(column: pa.Array) -> Iterator[dict[int, np.ndarray]]:
        for rows, x in _whole(column, len(project.middle)):
            w = project(x)[:, project.real]
            if w.size:
                yield {0: np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])}

    return run


def _identity_error(vectors: DataFrame, fit: Whitening, project: _Projection) -> float | None:
    """Largest absolute entry of the covariance of the whitened values, minus the identity."""
    k = int(project.real.sum())
    if not k:
        return None
    parts = vectors.select("embedding").mapInArrow(_per_task(_product_sums(project), "embedding", "key long, at long, value double"), "key long, at long, value double")
    rows = parts.groupBy("at").agg(F.sum("value").alias("value")).collect()  # at most 32 + 32^2 rows
    sums = np.zeros(k + k * k)
    for row in rows:
        sums[row["at"]] = row["value"]
    mean = sums[:k] / fit.n  # next to nothing: the values are centred before they are projected
    return float(np.abs(sums[k:].reshape(k, k) / fit.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, fit: Whitening, middle: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, null where it does not fit a long."""
    z = x - middle
    rest = [s - fit.n * int(m) for s, m in zip(fit.sums, middle)]
    reach = fit.n * (int(np.abs(z).max()) + 1)
    if len(rest) * reach**2 < 1 << 63:
        y = fit.n * z - np.array(rest, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = fit.n * z.astype(object) - np.array(rest, object)
    return [v if v < 1 << 63 else None for v in (y * y).sum(axis=1)]


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Per usable row of ``vectors`` (vec_id, embedding) and component (from 1): vec_id, component, n, deviation,
    whitened, explained, identity_error.

    Which rows are usable: see :func:`fit_whitening`; the others give no rows. There are as many components as
    dimensions, at most ``components``. A component without variance has a null ``whitened``; without any
    variance (one vector, or all equal) ``explained`` and ``identity_error`` are null too. ``deviation`` is null where it
    exceeds a long. Repeated rows and null ids are rows like others; further columns are ignored.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = fit_whitening(vectors)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], schema)
    project = _Projection(fit, components)
    error = _identity_error(vectors, fit, project)
    k, total = len(project.real), float(fit.values.sum())
    explained = fit.values[:k] / total if total > 0 else np.full(k, np.nan)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in _whole(batch.column("embedding"), len(fit.sums)):
                if not len(rows):
                    continue
                m, each = len(rows), np.repeat(np.arange(len(rows)), k)
                columns = [
                    batch.column("vec_id").take(pa.array(rows[each])),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, fit.n, np.int64)),
                    pa.array(_deviations(x, fit, project.middle), pa.int64()).take(pa.array(each)),
                    pa.array(project(x).ravel(), from_pandas=True),
                    pa.array(np.tile(explained, m), from_pandas=True),
                    pa.array([error] * (m * k), pa.float64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    given = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    return given.mapInArrow(run, schema)
