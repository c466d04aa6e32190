"""Whitening of vectors of integers by the leading components of their covariance.

Sums are exact and taken by Spark; the covariance is summed from centred blocks of rows. The matrix,
as wide as a vector, goes to the driver: Householder reflections make it tridiagonal, bisection with
Sturm counts finds the leading eigenvalues, inverse iteration their vectors, those of one cluster
made orthogonal to each other in every step. The few components are broadcast and every row is
projected where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourledger.llm.staging import staged

COMPONENTS = 8
#: Values beyond this are no integers of 64 bits once scaled and shifted.
LARGEST = float(1 << 61)
#: Rows worked on at a time hold about so many numbers.
NUMBERS = 1 << 20
#: Eigenvalues nearer than this share of the matrix's norm are one cluster.
CLUSTER = 1e-3
#: An eigenvalue below this share of the trace, for each dimension, is rounding.
ROUNDING = 1e-15


def householder(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal T with matrix = Q T Q', and Q."""
    a = np.array(matrix, np.float64)
    n = len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.max(np.abs(x), initial=0.0)
        if size == 0 or not np.any(x[1:]):
            continue
        v = x / size
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        # The trailing block becomes H A H, the column before it H x.
        p = a[k + 1 :, k + 1 :] @ v
        w = p - (v @ p) * v
        a[k + 1 :, k + 1 :] -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ x)
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def count_below(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues are smaller than each x: the negative pivots of T - x."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - x
    count = (pivot < 0).astype(int)
    for d, o in zip(diagonal[1:], off, strict=True):
        pivot = d - x - o * o / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues of a tridiagonal matrix, falling, by bisection to the last bit."""
    n = len(diagonal)
    reach = np.concatenate([np.abs(off), [0]]) + np.concatenate([[0], np.abs(off)])
    low, high = (np.full(wanted, x) for x in (np.min(diagonal - reach), np.max(diagonal + reach)))
    pad = np.finfo(float).eps * n * max(abs(low[0]), abs(high[0]))
    low, high = low - pad, high + pad
    rank = n - 1 - np.arange(wanted)  # so many are smaller
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return low
        below = count_below(diagonal, off, middle) <= rank
        low, high = np.where(below, middle, low), np.where(below, high, middle)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, x: float, right: np.ndarray, least: float) -> np.ndarray:
    """(T - x) y = right by elimination with row exchanges; a vanishing pivot counts as `least`."""
    n = len(diagonal)
    d, up, up2, y = diagonal - x, np.append(off, 0.0), np.zeros(n), right.copy()
    for i in range(n - 1):
        low = off[i]
        if abs(d[i]) < abs(low):
            # The next row (low, d, up) goes first.
            factor = d[i] / low
            d[i], d[i + 1], up[i], up2[i], up[i + 1] = low, up[i] - factor * d[i + 1], d[i + 1], up[i + 1], -factor * up[i + 1]
            y[i], y[i + 1] = y[i + 1], y[i] - factor * y[i + 1]
        else:
            d[i] = d[i] if abs(d[i]) > least else np.copysign(least, d[i])
            factor = low / d[i]
            d[i + 1] -= factor * up[i]
            y[i + 1] -= factor * y[i]
    d = np.where(np.abs(d) > least, d, np.copysign(least, d))
    for i in range(n - 1, -1, -1):
        y[i] = (y[i] - (up[i] * y[i + 1] if i + 1 < n else 0) - (up2[i] * y[i + 2] if i + 2 < n else 0)) / d[i]
    return y


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (rows) of falling eigenvalues by inverse iteration, orthogonal within clusters."""
    n, norm = len(diagonal), max(np.max(np.abs(diagonal)), np.max(np.abs(off), initial=0.0))
    least = np.finfo(float).eps * max(norm, np.finfo(float).tiny)
    found: list[np.ndarray] = []
    begin = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            begin = k
        # Equal values get shifts a few bits apart, or all would find one vector.
        shift = value - (k - begin) * 2 * least
        y = np.random.default_rng(k).uniform(0.5, 1.0, n) * np.where(np.arange(n) % 2, -1, 1)
        for _ in range(6):
            y = solve_shifted(diagonal, off, shift, y / np.max(np.abs(y)), least)
            y /= np.max(np.abs(y))
            for _ in range(2):
                for z in found[begin:]:
                    y = y - (y @ z) * z
            y /= np.sqrt(y @ y)
        found.append(y)
    return np.array(found).reshape(len(values), n)


def leading_components(covariance: np.ndarray, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit eigenvectors as rows, to double precision."""
    wanted = min(wanted, len(covariance))
    if not wanted:
        return np.zeros(0), np.zeros((0, len(covariance)))
    size = np.max(np.abs(covariance))
    if size == 0:
        return np.zeros(wanted), np.eye(len(covariance))[:wanted]
    diagonal, off, q = householder(covariance / size)
    values = leading_eigenvalues(diagonal, off, wanted)
    return values * size, eigenvectors(diagonal, off, values) @ q.T


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _parts(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    size = max(1, NUMBERS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x - S/n as doubles: whole + rest is S/n, and the whole part is taken away exactly."""
    return (x - whole).astype(np.float64) - rest


def _summed(partial: DataFrame, width: int) -> np.ndarray:
    """Sums of the tasks' rows (i, v), added up for each i."""
    cells = partial.select("i", F.posexplode("v").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    rows = cells.groupBy("i").agg(F.array_sort(F.collect_list(F.struct("j", "x"))).alias("cells")).select("i", F.col("cells.x").alias("v")).toArrow()
    out = np.zeros((width, width))
    for i, v in zip(rows.column("i").to_pylist(), rows.column("v").to_pylist(), strict=True):
        out[i] = v
    return out


def _covariance(x: DataFrame, n: int, whole: np.ndarray, rest: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
    """Covariance, divisor n, of the rows or of their projections on `weights`, centred before multiplying."""
    width = len(whole) if weights is None else len(weights)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for part in _parts(batches, len(whole)):
            y = _centred(_matrix(part.column(0), len(whole)), whole, rest)
            if weights is not None:
                y = y @ weights.T  # centred already: the mean of projections is the projection of the mean
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], ["i", "v"])

    return _summed(x.select("x").mapInArrow(products, "i int, v array<double>"), width) / n


def whiten(
    vectors: DataFrame, components: int = COMPONENTS, scale: int = 1024, shift: int = 100_000, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """id, component, n, deviation, whitened, explained and identity_error of every fitting row and component.

    Vectors become x = floor(scale * c) + shift. Rows whose vector is null, or holds null, non-finite
    or values too large for 64 bits, take no part; nor do vectors that are not as long as most are (of
    lengths as frequent, the largest). Components, from 1 by falling eigenvalue e, are unit
    eigenvectors of x's covariance over all n rows that take part, repeated ones and those of a null
    id included; there are no more than dimensions. `deviation` is the sum of (n*x - S)**2, null where
    it exceeds 64 bits. `whitened` is x - S/n projected on the component over sqrt(e); `explained` is
    e over the trace; `identity_error` the largest entry of whitened's covariance minus the identity.
    Where the covariance has fewer dimensions than components, the rest have null for `whitened` and
    do not count for `identity_error`; where all rows are equal, `explained` is null as well. An empty
    table gives no rows. The output's id keeps its name; other columns are not read. A matrix of d * d
    numbers for vectors of d numbers goes through the driver.
    """
    given = T.StructField("id", vectors.schema[id_col].dataType)
    c = F.col("v")
    rows = (
        vectors.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
        .where("v is not null")
        .where(F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < LARGEST / scale)))
        .select("id", F.transform(c, lambda e: F.floor(e * scale).cast("long") + F.lit(shift).cast("long")).alias("x"))
    )
    names = {"component": "integer", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}
    if id_col in names:
        raise ValueError(f"the column {id_col} would be there twice")
    schema = T.StructType([T.StructField(id_col, given.dataType)])
    for name, kind in names.items():
        schema = schema.add(name, kind)
    common = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = common.width if common else 0
    if not width:
        return vectors.sparkSession.createDataFrame([], schema)
    # Integers, written once: four passes read them.
    fitting = staged(rows.where(F.size("x") == width), "vectors")
    n = common["count"]
    places = fitting.select(F.posexplode("x").alias("j", "x"))
    totals = places.groupBy("j").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"), F.min("x").alias("low"), F.max("x").alias("high")).orderBy("j").collect()
    sums = [int(t.s) for t in totals]
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    covariance = _covariance(fitting, n, whole, rest)
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, axes = leading_components(covariance, components)
    real = values > max(trace, 0.0) * ROUNDING * width
    kept = int(real.sum())
    weights = axes[:kept] / np.sqrt(values[:kept, None])
    error = None
    if kept:
        error = float(np.max(np.abs(_covariance(fitting, n, whole, rest, weights) - np.eye(kept))))
    explained = [float(v / trace) if trace > 0 else None for v in values]
    # Whether every sum of squares of n*x - S fits into 64 bits.
    furthest = sum(max(abs(n * t.low - s), abs(n * t.high - s)) ** 2 for t, s in zip(totals, sums, strict=True))
    fits = furthest < 1 << 63

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # n*x - S, with the whole part of the mean taken away first: the product stays small.
        over = np.array([s % n for s in sums], np.int64 if fits else object)
        count = len(values)
        for part in _parts(batches, width):
            x = _matrix(part.column("x"), width)
            apart = (x - whole if fits else x.astype(object) - whole) * n - over
            apart = (apart * apart).sum(axis=1)
            apart = [int(d) if d < 1 << 63 else None for d in apart]
            made = _centred(x, whole, rest) @ weights.T
            places = np.repeat(np.arange(part.num_rows), count)
            component = np.tile(np.arange(count), part.num_rows)
            shown = np.pad(made, ((0, 0), (0, count - kept)))
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(places)), pa.array(component + 1, pa.int32()), pa.array(np.full(len(places), n)),
                 pa.array(apart, pa.int64()).take(pa.array(places)), pa.array(shown.ravel(), mask=component >= kept),
                 pa.array(explained, pa.float64()).take(pa.array(component)), pa.array([error] * len(places), pa.float64())],
                schema.names,
            )

    return fitting.select("id", "x").mapInArrow(project, schema)
