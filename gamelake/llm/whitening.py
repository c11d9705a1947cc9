"""Embedding whitening (operator 11): vectors in whole steps, projected on the leading components of their
covariance and scaled to unit variance.

1. Exact sums of every dimension (whole numbers) give the mean.
2. Each task adds up the products of its centred vectors; the matrices of the tasks are added row by row.
3. The matrix (dimensions squared, whatever the number of vectors) is solved on the driver: Householder
   reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, and inverse
   iteration their vectors, those of close eigenvalues made orthogonal to each other.
4. Mean and components, of bounded size, are broadcast, and every vector is projected where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches, materialise

COMPONENTS, SCALE, OFFSET = 8, 1024, 100_000
#: Dimensions that can be fitted: the matrix then takes 128 MB on the driver and in a task.
MAX_DIMENSIONS = 4096
#: Whole numbers of an entry stay within this, so that sums of a batch fit 64 bits.
LARGEST = 1 << 45


@dataclass(frozen=True)
class Whitening:
    """n vectors with the exact sums; components (one a row) by falling eigenvalue; total is the trace."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    total: float


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, the entries beside it, and the orthogonal Q (columns) with matrix = Q T Q'."""
    a = np.array(matrix, np.float64)
    d = len(a)
    q = np.eye(d)
    for k in range(d - 2):
        v = a[k + 1 :, k].copy()
        size = np.sqrt(v @ v)
        if size == 0.0 or not np.any(v[1:]):
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.sqrt(v @ v)
        p = a[k + 1 :, k + 1 :] @ v
        w = 2.0 * (p - (v @ p) * v)
        a[k + 1 :, k + 1 :] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] -= 2.0 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
        q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def counts_below(diagonal: np.ndarray, beside: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Eigenvalues of the tridiagonal matrix that are smaller than each x: the negative pivots of T - x."""
    tiny = np.finfo(np.float64).tiny / np.finfo(np.float64).eps
    below, pivot = np.zeros(len(x), np.int64), np.ones(len(x))
    for k, at in enumerate(diagonal):
        pivot = at - x - (beside[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, bisected until no double lies between the bounds."""
    d = len(diagonal)
    around = np.abs(np.concatenate(([0.0], beside))) + np.abs(np.concatenate((beside, [0.0])))
    low, high = np.full(k, (diagonal - around).min()), np.full(k, (diagonal + around).max())
    margin = np.finfo(np.float64).eps * max(np.abs(low).max(), np.abs(high).max()) * 4
    low, high = low - margin, high + margin
    wanted = d - np.arange(k)  # the i-th largest has d - i others that are not larger
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        reached = counts_below(diagonal, beside, middle) >= wanted
        high, low = np.where(open_ & reached, middle, high), np.where(open_ & ~reached, middle, low)


def _solve(diagonal: np.ndarray, beside: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """x of T x = b by elimination with row exchanges; pivots under least are replaced by it."""
    d = len(diagonal)
    main, upper, second, x = diagonal.copy(), np.append(beside, 0.0), np.zeros(d), b.copy()
    for k in range(d - 1):
        low, next_main, next_upper = beside[k], main[k + 1], upper[k + 1]
        if abs(low) > abs(main[k]):
            factor = main[k] / low
            main[k], main[k + 1] = low, upper[k] - factor * next_main
            upper[k], second[k], upper[k + 1] = next_main, next_upper, -factor * next_upper
            x[k], x[k + 1] = x[k + 1], x[k] - factor * x[k + 1]
        else:
            pivot = main[k] if abs(main[k]) > least else np.copysign(least, main[k])
            main[k], factor = pivot, low / pivot
            main[k + 1] = next_main - factor * upper[k]
            x[k + 1] -= factor * x[k]
    for k in range(d - 1, -1, -1):
        pivot = main[k] if abs(main[k]) > least else np.copysign(least, main[k])
        x[k] = (x[k] - (upper[k] * x[k + 1] if k + 1 < d else 0.0) - (second[k] * x[k + 2] if k + 2 < d else 0.0)) / pivot
    return x


def vectors_of(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (one a row) by inverse iteration. Vectors of eigenvalues that are closer than a
    thousandth of the matrix's size to the one before form a cluster and are kept orthogonal in it."""
    d, eps = len(diagonal), np.finfo(np.float64).eps
    size = max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0), np.finfo(np.float64).tiny / eps)
    rng, found, cluster = np.random.default_rng(42), np.empty((len(values), d)), 0
    shifts = values.copy()
    for i in range(len(values)):
        if i and values[i - 1] - values[i] > 1e-3 * size:
            cluster = i
        if i > cluster and shifts[i - 1] - shifts[i] < 4 * eps * size:
            shifts[i] = shifts[i - 1] - 4 * eps * size  # equal shifts would give one vector twice
        v = rng.standard_normal(d)
        for _ in range(5):
            for _twice in range(2):
                v -= found[cluster:i].T @ (found[cluster:i] @ v)
            v /= np.sqrt(v @ v)
            v = _solve(diagonal - shifts[i], beside, v, eps * size)
            v /= np.abs(v).max()
        for _twice in range(2):
            v -= found[cluster:i].T @ (found[cluster:i] @ v)
        found[i] = v / np.sqrt(v @ v)
    return found


def components_of(covariance: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The leading eigenvalues and unit eigenvectors (one a row), k at most; those that are zero but for
    rounding have no part."""
    d = len(covariance)
    if not d:
        return np.empty(0), np.empty((0, 0))
    scale = np.abs(covariance).max()
    if scale == 0.0:
        return np.empty(0), np.empty((0, d))
    diagonal, beside, q = tridiagonal(covariance / scale)
    values = leading_values(diagonal, beside, min(k, d))
    values = values[values > d * np.finfo(np.float64).eps * np.trace(covariance) / scale]
    return values * scale, vectors_of(diagonal, beside, values) @ q.T


def integer_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """key (long) and x (array of long), floor(1024 c) + 100000 of each entry c, one row for each row whose
    vector can be used.

    Vectors that are null, empty or hold null or non-finite entries are left out, and so are vectors that
    haven't the commonest length (of equally common ones the shortest). Entries beyond 2^45 steps count as
    that. Null keys and repeated rows stay, a row each. Other columns are left out; an empty table gives
    an empty one."""
    c = F.col(vector)
    fine = lambda e: F.coalesce(F.abs(e.cast("double")) < F.lit(float("inf")), F.lit(False)) & ~F.coalesce(F.isnan(e), F.lit(True))
    used = table.select(F.col(key).cast("long").alias("key"), c.alias("c")).filter(c.isNotNull() & (F.size("c") > 0) & F.forall("c", fine))
    step = lambda e: F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), e.cast("double") * SCALE))
    sizes = used.groupBy(F.size("c").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return used.select("key", F.lit(None).cast("array<bigint>").alias("x"))
    if sizes["d"] > MAX_DIMENSIONS:
        raise ValueError(f"{sizes['d']} dimensions; {MAX_DIMENSIONS} at most")
    return used.filter(F.size("c") == sizes["d"]).select("key", F.transform("c", lambda e: F.floor(step(e)).cast("long") + OFFSET).alias("x"))


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _added(parts: DataFrame) -> np.ndarray:
    """The sum of matrices that each task gave as rows (i, row array<double>)."""
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    rows = cells.groupBy("i").agg(F.transform(F.sort_array(F.collect_list(F.struct("j", "v"))), lambda s: s["v"]).alias("row")).collect()
    return np.array([r["row"] for r in sorted(rows, key=lambda r: r["i"])])


def _products(df: DataFrame, column: str, mean: np.ndarray, exact: tuple[int, list[int]] | None = None) -> np.ndarray:
    """Sums over all rows of the products of centred entries: one matrix a task, added up in the cluster."""
    d = len(mean)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                got = _matrix(batch.column(0), batch.num_rows)
                x = _from_mean(got, *exact) if exact else got - mean
                total += x.T @ x
        if total.any():
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(d), pa.int32()), "row": pa.array(list(total), pa.list_(pa.float64()))})

    found = _added(df.select(column).mapInArrow(add, "i int, row array<double>"))
    return found if found.size else np.zeros((d, d))


def _from_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n: whole parts first, so that large means cost no digits."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Mean and components of ``vectors`` (x, arrays of long, all of one length), over all its rows."""
    bounded_batches(vectors.sparkSession)
    sums = vectors.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    if not sums:
        return Whitening(0, (), np.empty(0), np.empty((0, 0)), 0.0)
    n, exact = int(sums[0]["n"]), [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])]
    covariance = _products(vectors, "x", np.zeros(len(exact)), (n, exact)) / n
    values, found = components_of(covariance, components)
    return Whitening(n, tuple(exact), values, found, float(np.trace(covariance)))


def project(vectors: DataFrame, model: Whitening) -> DataFrame:
    """key, deviation (decimal(38,0): the sum over dimensions of (n x - S)^2, exact) and whitened (array of
    double, one entry a component) of every row."""
    spark = vectors.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        n, sums = m.n, np.array(m.sums, object)
        mean = sums // max(1, n)
        scale = (m.components / np.sqrt(m.values)[:, None]).T
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), batch.num_rows)
            off = _from_mean(x, n, list(m.sums))
            if (float(np.abs(x - mean.astype(np.int64)).max()) + 1.0) ** 2 * float(n) ** 2 * x.shape[1] < 2.0**62:
                # n x - S = n (x - mean) - (S - n mean), all of it small
                part = n * (x - mean.astype(np.int64)) - (sums - n * mean).astype(np.int64)
                deviation = np.square(part).sum(1).tolist()
            else:
                deviation = [int(((n * row - sums) ** 2).sum()) for row in x.astype(object)]
            fits = [v if v < 10**38 else None for v in deviation]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if v is None else str(v) for v in fits]), pa.array(list(off @ scale), pa.list_(pa.float64()))], ["key", "deviation", "whitened"])

    got = vectors.select("key", "x").mapInArrow(each, "key long, deviation string, whitened array<double>")
    return got.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(projected: DataFrame, k: int) -> float | None:
    """The largest absolute entry of the covariance of ``whitened`` (k entries) minus the identity; None
    without rows or components."""
    if not k:
        return None
    means = projected.select(F.posexplode("whitened").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.count("*").alias("n")).collect()
    if not means:
        return None
    mean = np.array([r["m"] for r in sorted(means, key=lambda r: r["i"])])
    return float(np.abs(_products(projected, "whitened", mean) / means[0]["n"] - np.eye(k)).max())


def whiten(table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component (from 1), n, deviation (decimal(38,0), exact; null from 10^38 on), whitened,
    explained (share of the trace) and identity_error (one value) for each usable row and component.

    Which rows can be used: ``integer_vectors``. There are as many components as eigenvalues that aren't
    zero but for rounding, ``components`` at most, so equal vectors, one row or none give no rows. Null
    keys and repeated rows have rows of their own. Other columns are left out. Signs of components are free
    but the same for all rows. The projected rows are written once, for the check and the result."""
    vectors = integer_vectors(table, key, vector)
    vectors = materialise(vectors, "vectors")
    model = fit(vectors, components)
    k = len(model.values)
    if not k:
        return vectors.filter("false").select(F.col("key").alias(key), *(F.lit(None).cast(t).alias(c) for c, t in _ADDED))
    rows = materialise(project(vectors, model), "whitened")
    error = identity_error(rows, k)
    explained = F.array(*(F.lit(float(v / model.total)) for v in model.values))
    long = rows.select(F.col("key"), "deviation", F.posexplode("whitened").alias("at", "value"))
    return long.select(
        F.col("key").alias(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(explained, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


_ADDED = (("component", "int"), ("n", "long"), ("deviation", "decimal(38,0)"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double"))
