"""Embedding whitening: principal components of integer vectors and the rows projected on them.

An entry ``c`` becomes the integer ``floor(scale * c) + shift``. The fit list holds each different vector once. Sums are
exact integers; each task centres its vectors as ``(n * x - S) / n``, whose numerator is exact too, and adds
``d * d`` partial products, which Spark adds up by (row, column). The ``d * d`` matrix alone comes to the driver, where

1. Householder reflections make it tridiagonal,
2. bisection on Sturm counts finds each leading eigenvalue to the last bits,
3. inverse iteration finds its vector, made orthogonal to the others of its cluster in every step,
4. the reflections are applied backwards.

Components and means (``k * d`` numbers) are broadcast and every row is projected in its task. The whitened
covariance is measured over the fit list in a further pass, not inferred.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are left out, and so are those of another
length than most have (the longer of equally common ones); entries beyond 2**52 stop there; repeated rows count
once in the fit list and are all returned; null ids are carried; components whose eigenvalue is 0 to double precision
(one vector only, dependent dimensions) are left out; a deviation beyond a long is null; an empty table gives
no rows; further columns are not carried.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotweave.session import ensure_checkpoint_dir, ship_package

SCALE = 64
SHIFT = 1_000_000
LONGEST = float(1 << 52)
ROWS = 1024
EPS = np.finfo(np.float64).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and reflectors of a symmetric matrix: ``H ... H matrix H ... H``, ``H = I - 2 v v'``."""
    a = matrix.astype(np.float64).copy()
    n = len(a)
    reflectors = []
    for k in range(n - 2):
        x = a[k + 1 :, k]
        v = np.zeros(n - k - 1)
        norm = np.linalg.norm(x)
        if np.any(x[1:]):
            v = x.copy()
            v[0] += np.copysign(norm, x[0])
            v /= np.linalg.norm(v)
            own = a[k + 1 :, k + 1 :]
            w = own @ v
            w = 2 * (w - (v @ w) * v)
            own -= np.outer(v, w) + np.outer(w, v)
            a[k + 1, k] = -np.copysign(norm, x[0])
        reflectors.append(v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), reflectors


def above(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues are above each ``x``: positive terms of the Sturm sequence."""
    squares = np.concatenate(([0.0], off * off))
    least = EPS * EPS * max(1e-280, float(np.max(np.abs(diagonal), initial=0)) + float(np.max(np.abs(off), initial=0)))
    term = np.ones_like(x)
    count = np.zeros(len(x), dtype=np.int64)
    for d, s in zip(diagonal, squares):
        term = d - x - s / term
        term = np.where(np.abs(term) < least, -least, term)
        count += term > 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling: bisection of all intervals at once."""
    beside = np.concatenate(([0.0], np.abs(off), [0.0]))
    radius = beside[:-1] + beside[1:]
    room = EPS * max(float(np.max(np.abs(diagonal) + radius)), 1e-300)
    low = np.full(k, np.min(diagonal - radius) - room)
    high = np.full(k, np.max(diagonal + radius) + room)
    wanted = np.arange(1, k + 1)
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high) | (high - low <= room / 4)):
            return middle
        more = above(diagonal, off, middle) >= wanted
        low, high = np.where(more, middle, low), np.where(more, high, middle)


def _solver(diagonal: np.ndarray, off: np.ndarray, least: float):
    """Solve a tridiagonal system by elimination with row exchanges; pivots are ``least`` at least."""
    n = len(diagonal)
    d, upper, upper2 = diagonal.copy(), np.append(off, 0.0), np.zeros(n)
    factor, swapped = np.zeros(n), np.zeros(n, dtype=bool)
    for i in range(n - 1):
        below = off[i]
        if abs(below) > abs(d[i]):
            swapped[i] = True
            factor[i] = d[i] / below
            d[i], upper[i], upper2[i], row = below, d[i + 1], upper[i + 1], upper[i]
            d[i + 1] = row - factor[i] * upper[i]
            upper[i + 1] = -factor[i] * upper2[i]
        else:
            if abs(d[i]) < least:
                d[i] = least
            factor[i] = below / d[i]
            d[i + 1] -= factor[i] * upper[i]
    if abs(d[n - 1]) < least:
        d[n - 1] = least

    def solve(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for i in range(n - 1):
            if swapped[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factor[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= upper[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= upper2[i] * x[i + 2]
            x[i] /= d[i]
            if abs(x[i]) > 1e200:
                x *= 1e-200
        return x

    return solve


def vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """A unit eigenvector of each value as columns; values closer than a thousandth of the norm are one cluster."""
    n = len(diagonal)
    beside = np.concatenate(([0.0], np.abs(off), [0.0]))
    norm = float(np.max(np.abs(diagonal) + beside[:-1] + beside[1:]))
    random = np.random.default_rng(0)
    out = np.zeros((n, len(values)))
    first, shift = 0, 0.0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        # equal values of a cluster are set apart, so that their systems differ
        shift = value if j == first else min(value, shift - 10 * EPS * norm)
        solve = _solver(diagonal - shift, off, EPS * norm)
        cluster = out[:, first:j]
        x = random.standard_normal(n)
        for _ in range(rounds):
            for _ in range(2):
                x = x - cluster @ (cluster.T @ x)
            x = solve(x / np.linalg.norm(x))
            x = x / np.max(np.abs(x))
        for _ in range(2):
            x = x - cluster @ (cluster.T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    if len(matrix) == 1 or not np.any(matrix):
        k = min(k, len(matrix))
        return np.diagonal(matrix)[:k].copy(), np.eye(len(matrix), k)
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, min(k, len(matrix)))
    found = vectors(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        v = reflectors[i]
        found[i + 1 :] -= 2 * np.outer(v, v @ found[i + 1 :])
    return values, found


def blocks(column: pa.Array, dimensions: int) -> Iterator[np.ndarray]:
    """Vectors of a batch as matrices of at most ``ROWS`` rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)
    for first in range(0, len(flat), ROWS):
        yield flat[first : first + ROWS]


def column_sums(fit: DataFrame, dimensions: int) -> tuple[int, np.ndarray]:
    """Number of vectors and exact sums of each dimension (doubles where a long can't hold them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, lower, n = np.zeros(dimensions, np.int64), np.zeros(dimensions, np.int64), 0
        for batch in batches:
            for x in blocks(batch.column(0), dimensions):
                upper += (x >> 26).sum(axis=0)
                lower += (x & ((1 << 26) - 1)).sum(axis=0)
                n += len(x)
        count = pa.array(np.full(dimensions, n))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions)), pa.array(upper), pa.array(lower), count], ["i", "upper", "lower", "n"])

    parts = fit.select("x").mapInArrow(run, "i long, upper long, lower long, n long")
    rows = sorted(parts.groupBy("i").agg(F.sum("upper"), F.sum("lower"), F.sum("n")).collect())
    sums = [(upper << 26) + lower for _, upper, lower, _ in rows]
    return rows[0][3], np.array(sums, dtype=np.int64 if max(map(abs, sums)) < 1 << 62 else np.float64)


def away(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``, exact while it fits a long."""
    if sums.dtype == np.int64 and n * int(np.max(np.abs(x), initial=0)) < 1 << 62:
        return n * x - sums
    return n * x.astype(np.float64) - sums


def covariance(fit: DataFrame, n: int, sums: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance of the centred vectors, or of their projection, added up by entry."""
    dimensions = len(sums)
    size = dimensions if project is None else project.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for x in blocks(batch.column(0), dimensions):
                y = away(x, n, sums) / n
                if project is not None:
                    y = y @ project
                total += y.T @ y
        i, j = np.triu_indices(size)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "v"])

    out = np.zeros((size, size))
    for i, j, v in fit.select("x").mapInArrow(run, "i long, j long, v double").groupBy("i", "j").agg(F.sum("v")).collect():
        out[i, j] = out[j, i] = v / n
    return out


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Exact sum of ``(n * x - S)**2`` of each row; null beyond a long."""
    parts = away(x, n, sums)
    fits = np.sum(parts.astype(np.float64) ** 2, axis=1) < float(1 << 63) * (1 - 1e-9)
    fits &= parts.dtype == np.int64
    exact = np.sum(np.where(fits[:, None], parts, 0).astype(np.int64) ** 2, axis=1)
    return pa.array(exact, pa.int64(), mask=~fits)


def integer_vectors(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, x) of the rows whose vector is whole."""
    entry = lambda c: c.cast("double")
    whole = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < F.lit(float("inf"))))
    scaled = lambda c: F.greatest(F.least(F.floor(entry(c) * SCALE).cast("double"), F.lit(LONGEST)), F.lit(-LONGEST))
    x = F.transform(vector, lambda c: scaled(c).cast("long") + F.lit(SHIFT).cast("long"))
    return table.where(F.col(vector).isNotNull() & whole & (F.size(vector) > 0)).select(key, x.alias("x"))


def whiten(table: DataFrame, components: int = 16, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, eigenvalue, explained, identity_error), a row for each component."""
    spark = table.sparkSession
    ship_package(spark)
    rows = integer_vectors(table, key, vector)
    kind = rows.schema[key].dataType.simpleString()
    fields = f"`{key}` {kind}, component int, n long, deviation long, whitened double, eigenvalue double, explained double, identity_error double"
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return spark.createDataFrame([], fields)
    dimensions = common.d
    rows = rows.where(F.size("x") == dimensions)
    folder = f"{ensure_checkpoint_dir(spark)}/whitening-{uuid.uuid4().hex}"
    rows.select("x").distinct().write.parquet(folder)
    fit = spark.read.parquet(folder)

    n, sums = column_sums(fit, dimensions)
    matrix = covariance(fit, n, sums)
    trace = float(np.trace(matrix))
    values, found = leading_components(matrix, components)
    some = values > dimensions * EPS * max(trace, 0.0)
    values, found = values[some], found[:, some]
    if not len(values):
        return spark.createDataFrame([], fields)
    project = found / np.sqrt(values)
    error = float(np.max(np.abs(covariance(fit, n, sums, project) - np.eye(len(values)))))
    sent = spark.sparkContext.broadcast((n, sums, project, values, trace, error))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, project, values, trace, error = sent.value
        k = len(values)
        for batch in batches:
            first = 0
            for x in blocks(batch.column(1), dimensions):
                m = len(x)
                own = pa.array(np.repeat(np.arange(first, first + m), k))
                whitened = (away(x, n, sums) / n) @ project
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(own), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)), deviations(x, n, sums).take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(whitened.ravel()), pa.array(np.tile(values, m)), pa.array(np.tile(values / trace, m)), pa.array(np.full(m * k, error)),
                    ],
                    [key, "component", "n", "deviation", "whitened", "eigenvalue", "explained", "identity_error"],
                )
                first += m

    return rows.mapInArrow(run, fields)
