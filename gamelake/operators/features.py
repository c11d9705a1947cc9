"""Time-series features, samples, per-entity models, text vectors.

Grouped pandas functions see one entity's history; numpy only. They are used where a transform needs
the whole ordered series; rolling, lag and moving-average features are windows (``windows``), features of
whole series are in ``spectra``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.operators.windows import adjust_pvalues, trailing_array


def haar(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Approximation and detail of one Haar level; an odd last value is repeated."""
    if len(x) % 2:
        x = np.append(x, x[-1])
    return (x[::2] + x[1::2]) / np.sqrt(2.0), (x[::2] - x[1::2]) / np.sqrt(2.0)


def wave_fft(x: np.ndarray) -> np.ndarray:
    """Of rows of equal length: the mean Haar details of two levels and the two largest Fourier magnitudes
    after the mean; zeros for under two values."""
    n = x.shape[1]
    if n < 2:
        return np.zeros((len(x), 4))
    level = lambda v: v if v.shape[1] % 2 == 0 else np.concatenate([v, v[:, -1:]], 1)
    x1 = level(x)
    a, d1 = (x1[:, ::2] + x1[:, 1::2]) / np.sqrt(2.0), (x1[:, ::2] - x1[:, 1::2]) / np.sqrt(2.0)
    a = level(a) if n > 2 else a
    d2 = (a[:, ::2] - a[:, 1::2]) / np.sqrt(2.0) if a.shape[1] > 1 else np.zeros((len(x), 1))
    top = np.sort(np.abs(np.fft.rfft(x - x.mean(1, keepdims=True), axis=1)), axis=1)[:, ::-1][:, :2]
    return np.column_stack([d1.mean(1), d2.mean(1), top])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _wave_fft(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in parts:
        out, size = np.zeros((len(part), 4)), part.map(len).to_numpy()
        for n in np.unique(size[size > 0]):
            at = np.flatnonzero(size == n)
            out[at] = wave_fft(np.stack(part.to_numpy()[at]).astype(float))
        yield pd.Series(list(out))


def wave_features(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], col: str, n: int = 7) -> DataFrame:
    """wave_fft over the last n values: trailing windows, so no row sees what comes after it."""
    return trailing_array(df, keys, order, col, n).withColumn(f"{col}_wave", _wave_fft(F.col(f"{col}_last{n}").cast("array<double>"))).drop(f"{col}_last{n}")


def seasonal_terms(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], terms: int = 3, digits: int = 6) -> DataFrame:
    """Fourier cosine and sine terms of each row's place in its entity's series: windows only."""
    w = Window.partitionBy(*keys)
    t = (F.row_number().over(w.orderBy(*order)) - 1) / F.count(F.lit(1)).over(w)
    new = {f"{n}{k}": F.round(fn(F.lit(2 * np.pi * k) * F.col("_t")), digits) for k in range(1, terms + 1) for n, fn in (("cos", F.cos), ("sin", F.sin))}
    return df.withColumn("_t", t).withColumns(new).drop("_t")


def stratified_sample(df: DataFrame, strata: Sequence[str], key: Sequence[str], k: int, seed: int = 42) -> DataFrame:
    """At most k rows of each stratum, the same in every run: those with the smallest MD5 of key and seed.
    The rank filter is applied in part before the shuffle."""
    w = Window.partitionBy(*strata).orderBy(F.md5(F.concat_ws("-", *(F.col(c).cast("string") for c in key), F.lit(str(seed)))), *key)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def student_p(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Two-sided p-values of t statistics: the regularised incomplete beta function at df / (df + t^2), by
    its continued fraction."""
    from math import lgamma

    def fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
        near = lambda v: np.where(np.abs(v) < 1e-300, 1e-300, v)
        c, d = np.ones_like(x), 1.0 / near(1.0 - (a + b) * x / (a + 1.0))
        h = d.copy()
        for m in range(1, 400):
            for up in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d, c = 1.0 / near(1.0 + up * d), near(1.0 + up / c)
                h *= d * c
            if np.all(np.abs(d * c - 1.0) < 1e-14):
                break
        return h

    log_gamma = np.vectorize(lgamma, otypes=[float])
    a, b, square = df / 2.0, np.full(len(df), 0.5), np.minimum(np.square(t.astype(float)), 1e300)
    x, y = df / (df + square), square / (df + square)
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * np.log(np.maximum(x, 1e-300)) + b * np.log(np.maximum(y, 1e-300)))
    low = x < (a + 1.0) / (a + b + 2.0)
    p = np.where(low, front * fraction(a, b, np.where(low, x, 0.5)) / a, 1.0 - front * fraction(b, a, np.where(low, 0.5, y)) / b)
    return np.where(square == 0, 1.0, np.clip(p, 0.0, 1.0))


def nested_fits(s: np.ndarray, orders: np.ndarray, least: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From sums of products s (rows, size, size) of the columns 1, lag 1, ..., lag p, y over the same points: the
    order with the smallest AIC of each row, its coefficients, standard errors and degrees of freedom (nan
    beyond the order). One Cholesky factor gives all orders: the squares of y's last entries are what each
    order leaves. orders: the largest that a row may take; a lag that others explain ends the search.

    Columns are scaled to length one first, so that no decision depends on the unit of the values."""
    rows, size = len(s), s.shape[1]
    p_max, n = size - 2, s[:, 0, 0]
    scale = np.sqrt(np.maximum(np.einsum("rii->ri", s), 1e-300))
    c = s / scale[:, :, None] / scale[:, None, :]
    factor, sound = np.zeros_like(c), np.ones((rows, size), bool)
    for k in range(size):
        left = c[:, k, k] - np.square(factor[:, k, :k]).sum(1)
        sound[:, k] = left > 1e-10
        factor[:, k, k] = np.sqrt(np.maximum(left, 1e-300 if k < size - 1 else 0.0))
        if k < size - 1:
            factor[:, k + 1 :, k] = (c[:, k + 1 :, k] - np.einsum("rij,rj->ri", factor[:, k + 1 :, :k], factor[:, k, :k])) / np.where(sound[:, k], factor[:, k, k], np.inf)[:, None]
    rest = np.square(factor[:, -1, ::-1]).cumsum(1)[:, ::-1]  # of y, beyond each column
    best, order = np.full(rows, np.inf), np.full(rows, -1)
    usable = np.ones(rows, bool)
    for p in range(p_max + 1):
        usable &= sound[:, p] & (p <= orders) & (n - p - 1 >= 1)
        if p >= least:
            aic = n * np.log(np.maximum(rest[:, p + 1] / np.maximum(n, 1), 1e-24)) + 2 * (p + 1)
            better = usable & (aic < best)
            best, order = np.where(better, aic, best), np.where(better, p, order)
    coefficients, errors, df = np.full((rows, p_max + 1), np.nan), np.full((rows, p_max + 1), np.nan), np.maximum(n - order - 1, 1)
    for p in range(p_max + 1):
        at = np.flatnonzero(order == p)
        if len(at):
            inner = np.linalg.inv(factor[at, : p + 1, : p + 1])
            coefficients[at, : p + 1] = np.einsum("rji,rj->ri", inner, factor[at, -1, : p + 1]) * scale[at, -1:] / scale[at, : p + 1]
            spread = np.square(inner).sum(1) * (rest[at, p + 1] / df[at])[:, None]
            errors[at, : p + 1] = np.sqrt(spread) * scale[at, -1:] / scale[at, : p + 1]
    return order, coefficients, errors, df


def grouped_ar(df: DataFrame, key: str, order: Sequence[str], y: str, max_order: int = 3, min_order: int = 0) -> DataFrame:
    """Per entity an autoregression by least squares over its whole series, its order by AIC: coefficients with
    t statistics, Student's p-values, and these corrected within the entity (Bonferroni, Benjamini-Hochberg).

    Orders are compared on the points that all of them have, so no unit of the values changes the choice,
    and the chosen one is fitted on these points. An entity of n points tries orders up to (n - 1) / 2;
    without min_order + 3 points it has no rows. Points that are missing, or have a missing one among
    their lags, are left out. A series without variance has order 0.

    Lags are windows, and of each entity only the sums of products go to the solver, one row whatever
    its length. Values are taken from the entity's mean, so that the sums keep their digits."""
    at = Window.partitionBy(key)
    centred = df.select(key, *(c for c in dict.fromkeys(order) if c not in (key, y)), F.col(y).cast("double").alias("_y"), *([F.col(y)] if y in order and y != key else [])).withColumns({"_m": F.avg("_y").over(at), "_points": F.count("_y").over(at)})
    z = [(F.col("_y") - F.col("_m")) if i == 0 else F.lag(F.col("_y") - F.col("_m"), i).over(at.orderBy(*order)) for i in range(max_order + 1)]
    lagged = centred.select(key, "_m", "_points", *(c.alias(f"_z{i}") for i, c in enumerate(z)))
    most = F.greatest(F.lit(min_order), F.least(F.lit(max_order), F.floor((F.col("_points") - 1) / 2))).cast("int")
    whole = F.lit(True)
    for i in range(max_order + 1):
        whole = whole & (F.col(f"_z{i}").isNotNull() | (F.lit(i) > F.col("_most")))
    use = lagged.withColumn("_most", most).filter(whole & (F.col("_points") >= min_order + 3))
    columns = [F.lit(1.0), *(F.coalesce(F.col(f"_z{i}"), F.lit(0.0)) for i in [*range(1, max_order + 1), 0])]
    size = max_order + 2
    sums = F.array(*(F.sum(columns[i] * columns[j]) for i in range(size) for j in range(size)))
    kind = dict(df.dtypes)[key]

    def models(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            s = np.array(part["s"].tolist(), float).reshape(-1, size, size)
            found, c, e, free = nested_fits(s, part["most"].to_numpy(), min_order)
            # to the intercept of the values as they are: its error comes from the same sums, moved by the mean
            mean = part["mean"].to_numpy(float)
            error0 = _moved_error(s, found, mean, free)
            c[:, 0] += mean * (1.0 - np.nansum(c[:, 1:], 1))
            e[:, 0] = error0
            row, term = np.nonzero((np.arange(size - 1)[None, :] <= found[:, None]) & (found >= 0)[:, None])
            value, error = c[row, term], e[row, term]
            t = np.divide(value, error, out=np.where(value == 0, 0.0, np.copysign(np.inf, value)), where=error > 0)
            yield pd.DataFrame({key: part["key"].to_numpy()[row], "ar_order": found[row], "term": term, "coefficient": value, "t_value": t, "p_value": student_p(t, free[row])})

    got = use.groupBy(F.col(key).alias("key")).agg(F.first("_m").alias("mean"), F.first("_most").alias("most"), sums.alias("s")).mapInPandas(models, f"{key} {kind}, ar_order int, term int, coefficient double, t_value double, p_value double")
    return adjust_pvalues(got, [key], "p_value", "term")


def _moved_error(s: np.ndarray, order: np.ndarray, mean: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Standard error of the intercept when all values are raised by mean."""
    out = np.full(len(s), np.nan)
    for p in range(s.shape[1] - 1):
        at = np.flatnonzero(order == p)
        if len(at):
            a, b = s[at][:, : p + 1, : p + 1], s[at][:, : p + 1, -1]
            scale = np.sqrt(np.einsum("rii->ri", a))
            inverse = np.linalg.inv(a / scale[:, :, None] / scale[:, None, :]) / scale[:, :, None] / scale[:, None, :]
            beta = np.einsum("rij,rj->ri", inverse, b)
            left = np.maximum(s[at, -1, -1] - np.einsum("ri,ri->r", beta, b), 0.0)
            v = np.concatenate((np.ones((len(at), 1)), -mean[at, None] * np.ones((len(at), p))), 1)
            out[at] = np.sqrt(np.maximum(np.einsum("ri,rij,rj->r", v, inverse, v), 0.0) * left / free[at])
    return out


def embed_text(df: DataFrame, col: str, dim: int = 64, name: str = "vector") -> DataFrame:
    """Text as a normalised vector of hashed word counts; needs no fitted model. ``ml.embed_word2vec`` learns one."""
    from pyspark.ml.feature import HashingTF, Normalizer, Tokenizer

    words = Tokenizer(inputCol="_t", outputCol="_w").transform(df.withColumn("_t", F.coalesce(F.col(col), F.lit(""))))
    return Normalizer(inputCol="_f", outputCol=name).transform(HashingTF(inputCol="_w", outputCol="_f", numFeatures=dim).transform(words)).drop("_t", "_w", "_f")
