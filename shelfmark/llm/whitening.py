"""Whitening of embeddings by the leading components of their covariance.

Components of vectors become integers floor(SCALE * c). The model is fitted on the distinct integer vectors: exact
sums per dimension first, then the covariance of the vectors less their mean, summed up from one matrix per task in
strips of rows. The covariance, dims x dims numbers whatever the number of vectors, is reduced to a tridiagonal
matrix by Householder reflections. Sturm counts tell how many eigenvalues lie above a number, so bisection
finds the leading ones; inverse iteration gives their vectors, kept orthogonal within clusters of close
eigenvalues; the reflections carry them back. Every row is then projected on the broadcast components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from shelfmark.llm.blocks import ready, staged

SCALE = 256
COMPONENTS = 4
STRIP = 64  # rows of the covariance that are added up together
SALTS = 16
CLUSTER = 1e-3  # eigenvalues closer than this share of the largest are one cluster
PARTIAL = "strip int, salt int, n long, sums binary"
LONG = 1 << 63
EPS = np.finfo(np.float64).eps


@dataclass
class Model:
    """Number of distinct vectors, their sums per dimension, eigenvalues and components (as rows), trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components.T / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum)^2, exactly; null where it is beyond a long."""
        if not x.size:
            return [0] * len(x)
        largest = max(abs(int(x.max())), abs(int(x.min()))) * self.n + max(map(abs, self.sums))
        if largest * largest * len(self.sums) < LONG:
            found = (x * self.n - np.array(self.sums, dtype=np.int64)) ** 2
            return found.sum(axis=1).tolist()
        exact = [sum((v * self.n - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [e if e < LONG else None for e in exact]


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and off-diagonal of Q'AQ for a symmetric matrix, and the unit vectors of the reflections of Q."""
    a = np.array(a, dtype=np.float64)
    d, reflections = len(a), []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.sqrt(x @ x)
        if norm > 0:
            x[0] += np.copysign(norm, x[0])
            x /= np.sqrt(x @ x)
            rest = a[k + 1 :, k + 1 :]
            p = 2 * (rest @ x)
            q = p - (x @ p) * x
            rest -= np.outer(x, q) + np.outer(q, x)
            a[k + 1, k] = a[k, k + 1] = -np.copysign(norm, a[k + 1, k])
        reflections.append(x)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def counts_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues of a tridiagonal matrix lie above each shift."""
    least = EPS * max(1e-300, float(np.abs(diagonal).max()), float(np.abs(off).max()) if len(off) else 0.0)
    above, q = np.zeros(len(shifts), dtype=np.int64), np.ones(len(shifts))
    for k in range(len(diagonal)):
        q = diagonal[k] - shifts - (off[k - 1] ** 2 / q if k else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        above += q > 0
    return above


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection down to neighbouring numbers."""
    radius = np.append(np.abs(off), 0) + np.append(0, np.abs(off))
    low = np.full(count, float((diagonal - radius).min()) - 1e-300)
    high = np.full(count, float((diagonal + radius).max()))
    high += EPS * np.abs(high) * 4 + 1e-300
    rank = np.arange(count)
    for _ in range(200):
        middle = (low + high) / 2
        if ((middle <= low) | (middle >= high)).all():
            break
        more = counts_above(diagonal, off, middle) > rank
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return (low + high) / 2


def solve(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """Solution of (T - shift) y = right, by elimination with row exchanges."""
    d = len(diagonal)
    least = EPS * max(float(np.abs(diagonal).max()), float(np.abs(off).max()) if d > 1 else 0.0, 1e-300)
    main, upper, second, b = diagonal - shift, np.append(off, 0.0), np.zeros(d), right.copy()
    for k in range(d - 1):
        below, at = off[k], main[k]
        if abs(below) > abs(at):  # exchange rows k and k + 1
            main[k], upper[k], second[k], b[k], main[k + 1], up, b[k + 1] = (
                below, main[k + 1], upper[k + 1], b[k + 1], upper[k], 0.0, b[k],
            )
            factor = at / below
            main[k + 1] -= factor * upper[k]
            upper[k + 1] = up - factor * second[k]
        else:
            factor = below / (at if abs(at) > least else (least if at >= 0 else -least))
            main[k + 1] -= factor * upper[k]
        b[k + 1] -= factor * b[k]
    main = np.where(np.abs(main) < least, least, main)
    y = np.zeros(d)
    for k in range(d - 1, -1, -1):
        y[k] = b[k]
        if k + 1 < d:
            y[k] -= upper[k] * y[k + 1]
        if k + 2 < d:
            y[k] -= second[k] * y[k + 2]
        y[k] /= main[k]
        if abs(y[k]) > 1e200:  # only the direction counts
            y, b = y * 1e-200, b * 1e-200
    return y


def components_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, reflections: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvectors of the full matrix, one row per eigenvalue, by inverse iteration."""
    d, found = len(diagonal), []
    start = np.random.default_rng(5)
    norm = max(float(np.abs(values).max()), 1e-300) if len(values) else 1.0
    for k, value in enumerate(values):
        cluster = [found[j] for j in range(k) if abs(values[j] - value) < CLUSTER * norm]
        y = start.normal(size=d)
        for _ in range(5):
            for _ in range(2):
                for other in cluster:
                    y -= (other @ y) * other
            y /= np.sqrt(y @ y)
            y = solve(diagonal, off, float(value), y)
            y /= np.abs(y).max()
        for _ in range(2):
            for other in cluster:
                y -= (other @ y) * other
            y /= np.sqrt(y @ y)
        found.append(y)
    rows = np.array(found).reshape(len(values), d)
    for k in range(len(reflections) - 1, -1, -1):
        x = reflections[k]
        rows[:, k + 1 :] -= 2 * np.outer(rows[:, k + 1 :] @ x, x)
    return rows


def integers(vector: Column) -> Column:
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of `dims` integers; shorter vectors end in zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False)
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _added(parts: DataFrame) -> DataFrame:
    """Sums of the strips, in two steps so that no task gathers those of all others."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, strip, salt = None, 0, 0, 0
        for batch in batches:
            for p, s, c, blob in zip(*[batch.column(x) for x in ("strip", "salt", "n", "sums")], strict=True):
                part = np.frombuffer(blob.as_buffer(), dtype=np.float64)
                total = part.copy() if total is None else total + part
                n, strip, salt = n + c.as_py(), p.as_py(), s.as_py()
        yield pa.RecordBatch.from_pydict(
            {"strip": pa.array([strip], pa.int32()), "salt": pa.array([salt], pa.int32()), "n": pa.array([n], pa.int64()), "sums": [total.tobytes()]}
        )

    return parts.groupBy("strip", "salt").applyInArrow(add, PARTIAL).groupBy("strip").applyInArrow(add, PARTIAL)


def _second_moments(points: DataFrame, dims: int, width: int, rows_of) -> np.ndarray:
    """Sum of the outer products of the rows that `rows_of` makes of each matrix of vectors, width x width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for batch in batches:
            if batch.num_rows:
                rows = rows_of(_matrix(batch.column("x"), dims))
                total += rows.T @ rows
                n += batch.num_rows
        if n:
            cuts = range(0, width, STRIP)
            yield pa.RecordBatch.from_pydict(
                {
                    "strip": pa.array([k // STRIP for k in cuts], pa.int32()),
                    "salt": pa.array([TaskContext.get().partitionId() % SALTS] * len(cuts), pa.int32()),
                    "n": pa.array([n] * len(cuts), pa.int64()),
                    "sums": [total[k : k + STRIP].tobytes() for k in cuts],
                }
            )

    strips = _added(points.mapInArrow(run, PARTIAL)).orderBy("strip").collect()  # width x width numbers
    return np.concatenate([np.frombuffer(r["sums"]) for r in strips]).reshape(width, width)


def fit(vectors: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> Model | None:
    """The model of the distinct integer vectors; null if there are none.

    Eigenvalues that are zero but for rounding have no component, so there may be fewer than asked for.
    """
    ready(vectors.sparkSession)
    rows = usable(vectors, vector)
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return None
    filled = F.when(F.size("x") == dims, F.col("x")).otherwise(
        F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    )
    points = staged(rows.select(filled.alias("x")).distinct(), "fit-list")
    n = points.count()
    exact = points.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"))
    sums = [int(r["s"]) for r in exact.orderBy("k").collect()]
    model = Model(n, sums, np.zeros(0), np.zeros((0, dims)), 0.0)
    if not dims:
        return model
    mean = model.mean
    covariance = _second_moments(points, dims, dims, lambda x: x - mean) / n
    covariance = (covariance + covariance.T) / 2
    model.trace = float(np.trace(covariance))
    diagonal, off, reflections = tridiagonal(covariance)
    values = leading_values(diagonal, off, min(components, dims))
    model.values = values[values > model.trace * dims * EPS * 16]
    model.components = components_of(diagonal, off, model.values, reflections)
    if len(model.values):
        width = len(model.values)

        def with_one(x: np.ndarray) -> np.ndarray:
            return np.column_stack([model.whitened(x), np.ones(len(x))])

        moments = _second_moments(points, dims, width + 1, with_one) / n
        centre = moments[:width, width]
        off_identity = moments[:width, :width] - np.outer(centre, centre) - np.eye(width)
        model.identity_error = float(np.abs(off_identity).max())
    return model


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and holds finite numbers only, with the integer vector x beside their columns."""
    bad = F.exists(F.col(vector).cast("array<double>"), lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.where(F.col(vector).isNotNull()).where(~bad)
    return kept.withColumn("x", integers(F.col(vector)))


def whiten(vectors: DataFrame, model: Model | None, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row per usable vector and component: the id, component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite numbers are left out; a null id stays. Shorter vectors
    count as if they ended in zeros, and integers beyond a long as the nearest long. Repeated rows are all returned, but
    count once in the fit. Equal eigenvalues get orthogonal components of their common space. Where all vectors are equal, or
    there are none, there is no component and so no row. A deviation beyond a long is null. Other columns, whatever
    their names, are left out.
    """
    spark = ready(vectors.sparkSession)
    kind = vectors.schema[id].dataType.simpleString()
    schema = f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    dims, width = model.components.shape[1], len(model.values)
    shared = spark.sparkContext.broadcast(model)  # as large as `width` vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        explained = fitted.values / fitted.trace
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            n = len(x)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(n), width))),
                    pa.array(np.tile(np.arange(1, width + 1), n), pa.int32()),
                    pa.array(np.full(n * width, fitted.n), pa.int64()),
                    pa.array([d for d in fitted.deviations(x) for _ in range(width)], pa.int64()),
                    pa.array(fitted.whitened(x).ravel(), pa.float64()),
                    pa.array(np.tile(explained, n), pa.float64()),
                    pa.array(np.full(n * width, fitted.identity_error), pa.float64()),
                ],
                [id, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    rows = usable(vectors.select(F.col(id).alias("id"), F.col(vector).alias("v")), "v")
    return rows.select("id", "x").mapInArrow(run, schema)
