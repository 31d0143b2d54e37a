"""Whitening of embeddings: projections on the leading eigenvectors of their covariance, each scaled to variance one.

Entries become integers, floor(64 c) + 1000000, so that counts and sums are exact.  The covariance is summed in tasks over vectors that are
centred before they are multiplied; its rows are added over the cluster, and what reaches the driver is one matrix of the
vectors' dimension, whatever their number.  There it is brought to tridiagonal form by Householder reflections, bisection with Sturm
counts finds the leading eigenvalues, and inverse iteration their vectors, orthogonalised anew within clusters of near eigenvalues.  The
projection, of fixed size, is broadcast; vectors are projected where they are.

Defined results: a vector that is null or holds null or non-finite entries has no row; shorter vectors (empty ones too) count as padded
with zeros; entries beyond 2^52 / 64 count as that; equal rows have equal results, each counts; a null vec_id stays null; components
whose eigenvalue is below ``RANK`` of the largest hold rounding only and are not given, so equal vectors, a single one and an
empty table give no rows; a deviation that no long holds is an error.  Columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspan.session import write_stage

COMPONENTS = 32
UNIT, SHIFT, LARGEST = 64, 1_000_000, 1 << 52
#: Eigenvalues below this share of the largest are rounding.
RANK = 1e-10
#: Partial matrices of a covariance, at most; vectors centred at once in a task.
PARTIALS = 4096
CHUNK = 4096
#: Bits of the low part of an entry, so that sums of both parts fit a long.
LOW = 26
#: Eigenvalues whose gap is below this share of the largest are a cluster.
CLUSTER = 1e-3
EPS = np.finfo(float).eps


@dataclass
class Whitening:
    """What was fitted: of ``n`` vectors the exact sums, the trace of their covariance and its leading eigenvalues and vectors (columns)."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    axes: np.ndarray

    @property
    def base(self) -> np.ndarray:
        """The whole part of the means; ``rest`` is what is left of them."""
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def left(self) -> list[int]:
        return [s % self.n for s in self.sums]

    @property
    def rest(self) -> np.ndarray:
        return np.array([x / self.n for x in self.left])


# --- eigenvalues and vectors of a symmetric matrix -------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and the orthogonal q with q' A q = T, by Householder reflections."""
    a, n = np.array(matrix, float), len(matrix)
    q = np.eye(n)
    for k in range(n - 2):
        column = a[k + 1 :, k].copy()
        length = np.sqrt((column * column).sum())
        if length == 0 or not column[1:].any():
            continue
        v = column
        v[0] += np.copysign(length, v[0])
        v /= np.sqrt((v * v).sum())
        part = a[k + 1 :, k + 1 :]
        p = part @ v
        w = 2 * (p - (v @ p) * v)
        part -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= np.outer(2 * (q[:, k + 1 :] @ v), v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix are smaller than each of ``at``: the negative terms of its Sturm sequence."""
    tiny = EPS * EPS * max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0), 1e-200)
    pivot = diagonal[0] - at
    count = (pivot < 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off, strict=True):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = d - at - e * e / pivot
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection of all of them side by side."""
    n = len(diagonal)
    reach = np.r_[0, np.abs(off)] + np.r_[np.abs(off), 0]
    spread = np.abs(diagonal).max() + reach.max()
    rank = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    low, high = np.full(k, (diagonal - reach).min() - EPS * spread), np.full(k, (diagonal + reach).max() + EPS * spread)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= EPS * EPS * spread)).all():
            return middle
        small = below(diagonal, off, middle) <= rank
        low, high = np.where(small, middle, low), np.where(small, high, middle)


def solve_tridiagonal(diagonal: np.ndarray, off: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """x with (T - value) x = right, by elimination with row exchanges; pivots are at least ``least``."""
    n = len(diagonal)
    main, up, far = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * n
    x = right.tolist()
    for i in range(n - 1):
        under, nextmain, nextup = float(off[i]), main[i + 1], up[i + 1]
        if abs(under) > abs(main[i]):
            main[i], under = under, main[i]
            up[i], nextmain = nextmain, up[i]
            far[i], nextup = nextup, 0.0
            x[i], x[i + 1] = x[i + 1], x[i]
        elif abs(main[i]) < least:
            main[i] = least
        ratio = under / main[i]
        main[i + 1], up[i + 1] = nextmain - ratio * up[i], nextup - ratio * far[i]
        x[i + 1] -= ratio * x[i]
    if abs(main[-1]) < least:
        main[-1] = least
    for i in range(n - 1, -1, -1):
        x[i] -= (up[i] * x[i + 1] if i + 1 < n else 0.0) + (far[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] /= main[i]
    return np.array(x)


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) for ``values``, falling, by inverse iteration; those of a cluster are kept orthogonal."""
    n, norm = len(diagonal), max(np.abs(values).max(initial=0), 1e-150)
    draw = np.random.default_rng(1)
    vectors, start, near = np.zeros((n, len(values))), 0, np.inf
    for j, value in enumerate(values.tolist()):
        if j and values[j - 1] - value > CLUSTER * norm:
            start = j
        if j > start:
            value = min(value, near - 8 * EPS * norm)  # equal eigenvalues are told apart
        near = value
        x = draw.standard_normal(n)
        for _ in range(4):
            x /= np.abs(x).max()
            x = solve_tridiagonal(diagonal, off, value, x, EPS * norm)
            x /= np.abs(x).max()
            for _ in range(2):
                for i in range(start, j):
                    x -= (vectors[:, i] @ x) * vectors[:, i]
            x /= np.sqrt((x * x).sum())
        vectors[:, j] = x
    return vectors


def leading_eigen(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors (columns), the largest entry of each positive."""
    k = min(k, len(matrix))
    if not k:
        return np.zeros(0), np.zeros((len(matrix), 0))
    diagonal, off, q = tridiagonal(matrix)
    values = leading_values(diagonal, off, k)
    axes = q @ tridiagonal_vectors(diagonal, off, values)
    axes /= np.sqrt((axes * axes).sum(axis=0))
    top = axes[np.abs(axes).argmax(axis=0), np.arange(k)]
    return values, axes * np.where(top < 0, -1.0, 1.0)


# --- over the cluster ------------------------------------------------------------------------------


def finite(vector: Column) -> Column:
    """Whether a vector is there and holds finite numbers only."""
    return F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))


def integers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, x) of the vectors that take part, as written, and their dimension."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e")).where(finite(F.col("e")))
    bound = float(LARGEST)
    entry = lambda c: F.floor(F.greatest(F.least(UNIT * c, F.lit(bound)), F.lit(-bound))) + SHIFT
    rows = write_stage(rows.select("vec_id", F.transform("e", entry).alias("x")), "whitening-integers")
    least, dim = rows.agg(F.min(F.size("x")), F.max(F.size("x"))).collect()[0]
    if dim and least < dim:
        rows = rows.select("vec_id", F.concat("x", F.array_repeat(F.lit(SHIFT).cast("long"), dim - F.size("x"))).alias("x"))
    return rows, dim or 0


def matrix_of(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def centred_products(rows: DataFrame, name: str, base: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The sum over all rows of c c', where c is the array ``name`` less ``base`` and less ``rest``."""
    dim = len(base)
    spark, schema = rows.sparkSession, "i int, line binary"
    centre = spark.sparkContext.broadcast((base, rest))  # of the vectors' dimension

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((dim, dim)), False
        for batch in (x for x in batches if x.num_rows):
            data, seen = matrix_of(batch.column(0), dim), True
            for at in range(0, len(data), CHUNK):
                c = (data[at : at + CHUNK] - centre.value[0]) - centre.value[1]
                total += c.T @ c
        if seen:
            lines = pa.array([line.tobytes() for line in total], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), lines], names=["i", "line"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(dim)
        for batch in batches:
            for i, line in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if i != now and now is not None:
                    yield pa.RecordBatch.from_pydict({"i": pa.array([now], pa.int32()), "line": [total.tobytes()]})
                if i != now:
                    now, total = i, np.zeros(dim)
                total += np.frombuffer(line.as_buffer())
        if now is not None:
            yield pa.RecordBatch.from_pydict({"i": pa.array([now], pa.int32()), "line": [total.tobytes()]})

    parts = rows.select(name).coalesce(PARTIALS).mapInArrow(multiply, schema)
    lines = parts.repartition("i").sortWithinPartitions("i").mapInArrow(add, schema).collect()  # one row a dimension
    out = np.zeros((dim, dim))
    for r in lines:
        out[r["i"]] = np.frombuffer(r["line"])
    return (out + out.T) / 2


def fit_whitening(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of integer vectors ``rows`` (vec_id, x) of dimension ``dim``; None where nothing varies."""
    if not dim:
        return None
    entry = F.col("c")
    parts = rows.select(F.posexplode("x").alias("i", "c")).groupBy("i")
    sums = parts.agg(F.count("*").alias("n"), F.sum(F.shiftright(entry, LOW)).alias("high"), F.sum(entry.bitwiseAND((1 << LOW) - 1)).alias("low")).collect()
    sums = sorted(sums, key=lambda r: r["i"])  # one row a dimension
    model = Whitening(sums[0]["n"], [(r["high"] << LOW) + r["low"] for r in sums], 0.0, np.zeros(0), np.zeros((dim, 0)))
    covariance = centred_products(rows, "x", model.base, model.rest) / model.n
    model.trace = float(np.trace(covariance))
    values, axes = leading_eigen(covariance, components)
    kept = int((values > max(RANK * values[0], 0.0)).sum())
    model.values, model.axes = values[:kept], axes[:, :kept]
    return model if kept else None


def deviations(data: np.ndarray, model: Whitening) -> list[int] | np.ndarray:
    """The exact sum over dimensions of (n x - S)^2."""
    shifted = data - model.base
    most = model.n * (int(np.abs(shifted).max(initial=0)) + 1)
    if most * most * len(model.sums) < 1 << 63:
        off = model.n * shifted - np.array(model.left, np.int64)
        return (off * off).sum(axis=1)
    off = model.n * shifted.astype(object) - np.array(model.left, object)
    return (off * off).sum(axis=1).tolist()


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened): ``whitened`` holds a vector's value on each component."""
    dim, k = model.axes.shape
    known = rows.sparkSession.sparkContext.broadcast((model, model.axes / np.sqrt(model.values)))  # of the vectors' dimension

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, axes = known.value
        for batch in (x for x in batches if x.num_rows):
            data = matrix_of(batch.column(1), dim)
            out = np.ascontiguousarray(((data - fitted.base) - fitted.rest) @ axes)
            ends = pa.array(np.arange(0, k * len(out) + 1, k, dtype=np.int32))
            columns = [batch.column(0), pa.array(deviations(data, fitted), pa.int64()), pa.ListArray.from_arrays(ends, pa.array(out.ravel()))]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "deviation", "whitened"])

    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, n: int, k: int) -> float:
    """The largest absolute entry of the covariance of ``whitened`` less the identity."""
    means = whitened.select(F.posexplode("whitened").alias("i", "c")).groupBy("i").agg(F.avg("c").alias("mean")).collect()  # one row a component
    centre = np.array([r["mean"] for r in sorted(means, key=lambda r: r["i"])])
    covariance = centred_products(whitened, "whitened", np.zeros(k), centre) / n
    return float(np.abs(covariance - np.eye(k)).max())


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dim = integers(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    model = fit_whitening(rows, dim)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return spark.createDataFrame([], schema)
    done = write_stage(whiten(rows, model), "whitening-whitened")
    explained = F.element_at(F.array(*[F.lit(float(v / model.trace)) for v in model.values]), F.col("component"))
    wide = done.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")).withColumn("component", F.col("place") + 1)
    n, error = F.lit(model.n).cast("long"), F.lit(identity_error(done, model.n, len(model.values)))
    return wide.select("vec_id", "component", n.alias("n"), "deviation", "whitened", explained.alias("explained"), error.alias("identity_error"))
