"""Features of whole series of any length: Fourier and Haar magnitudes, moving average.

A series is cut into chunks of ``CHUNK`` values (a row each). Haar details of two levels lie inside chunks,
and an exponential average is a sum over them. A series of one chunk is transformed at once. A longer one goes
through Bluestein's chirp convolution (any length becomes a power of two, M = R C) as three groupings, so
that a task holds TILE short transforms of R or C values, never the series:

1. by the remainder r of the place modulo R: transforms of C values, turned by exp(-2 pi i r q / M);
2. by q: transforms of R values complete the spectra of series and chirp; their product is transformed back
   over R values and turned by exp(2 pi i q t / M);
3. by t: transforms of C values complete the convolution, whose values times the chirp are the spectrum.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.operators import scans
from gamelake.sources.tables import written

#: Values of a chunk (a multiple of 4), and short transforms of one group.
CHUNK, TILE = 8192, 64
#: Values of the series of one length that are transformed at once.
STACK = 1 << 20


def haar_coefficients(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a series, or of each row: second-level means, second-level details and first-level details; an odd last
    value is repeated."""

    def level(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        v = np.concatenate((v, v[..., -1:]), axis=-1) if v.shape[-1] % 2 else v
        return (v[..., ::2] + v[..., 1::2]) / np.sqrt(2.0), (v[..., ::2] - v[..., 1::2]) / np.sqrt(2.0)

    means, first = level(x)
    return (*level(means), first)


def largest(x: np.ndarray, top: int) -> list:
    """The largest magnitudes, falling, of a series or of each row."""
    return np.sort(np.abs(x), axis=-1)[..., ::-1][..., :top].tolist()


def average_of(x: np.ndarray, alpha: float, opens: bool) -> np.ndarray:
    """What a chunk, or each row, adds to the exponential average at its own end; the first value of a series has
    full weight."""
    many = x.shape[-1]
    size = min(many, 1 + int(np.ceil(np.log(1e-30) / np.log1p(-alpha)))) if alpha < 1 else 1
    weights = alpha * (1 - alpha) ** np.arange(size - 1, -1, -1.0)
    if opens and size == many:
        weights[0] = (1 - alpha) ** (many - 1)
    return x[..., many - size :] @ weights


def _sizes(n: int) -> tuple[int, int, int]:
    """M, R and C of a series of n values."""
    bits = max(2 * TILE.bit_length(), (2 * n - 1).bit_length())
    return 1 << bits, 1 << bits // 2, 1 << bits - bits // 2


def _chirp(j: np.ndarray, n: int) -> np.ndarray:
    """exp(-pi i j^2 / n), the square taken modulo 2 n so that no digits are lost."""
    j = np.abs(j) % (2 * n)
    return np.exp(-1j * np.pi * ((j * j) % (2 * n)) / n)


def _flat(x: np.ndarray) -> list[float]:
    return np.ascontiguousarray(x).view(np.float64).ravel().tolist()


def by_remainder(n: int, first: int, places: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Step 1 for the remainders first to first + TILE - 1: (2, TILE, C), of the series and of the chirp."""
    m, r_size, c_size = _sizes(n)
    both = np.zeros((2, TILE, c_size), complex)
    both[0, places % r_size - first, places // r_size] = values * _chirp(places, n)
    rest = first + np.arange(TILE)[:, None]
    at = np.arange(c_size)[None, :] * r_size + rest
    at = np.where(at > m // 2, at - m, at)
    both[1] = np.where(np.abs(at) < n, np.conj(_chirp(at, n)), 0)
    return np.fft.fft(both, axis=2) * np.exp(-2j * np.pi * (rest * np.arange(c_size)[None, :] % m) / m)


def by_frequency(n: int, first: int, both: np.ndarray) -> np.ndarray:
    """Step 2 for the frequencies first to first + TILE - 1, from (2, R, TILE): (TILE, R)."""
    m, r_size, _ = _sizes(n)
    series, chirp = np.fft.fft(both, axis=1)
    turned = np.exp(2j * np.pi * ((first + np.arange(TILE))[:, None] * np.arange(r_size)[None, :] % m) / m)
    return np.fft.ifft((series * chirp).T, axis=1) * turned


def by_place(n: int, first: int, got: np.ndarray) -> np.ndarray:
    """Step 3 for the places first to first + TILE - 1 modulo R, from (C, TILE): magnitudes of the spectrum up to
    half of n."""
    _, r_size, c_size = _sizes(n)
    k = np.arange(c_size)[:, None] * r_size + (first + np.arange(TILE))[None, :]
    # the two-step inverse transforms divide by R and by C
    return np.abs(np.fft.ifft(got, axis=0)[k <= n // 2])


def _long_spectra(chunks: DataFrame, key: str, kind: str, top: int) -> DataFrame:
    """key, measure, value: the largest magnitudes that each group of step 3 has, of series of several chunks."""
    at = [key, "measure", "n"]
    points = chunks.select(*at, F.posexplode("x").alias("i", "v"), (F.col("chunk") * CHUNK).alias("begin")).select(*at, (F.col("begin") + F.col("i")).cast("long").alias("j"), "v")
    own = f"`{key}` {kind}, measure string, n long"

    def head(pdf: pd.DataFrame) -> list:
        return [pdf[c].iloc[0] for c in at]

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        n, tile = int(pdf["n"].iloc[0]), int(pdf["tile"].iloc[0])
        both = by_remainder(n, tile * TILE, pdf["j"].to_numpy(), pdf["v"].to_numpy())
        return pd.DataFrame([(*head(pdf), tile, q, _flat(both[:, :, q * TILE : (q + 1) * TILE])) for q in range(both.shape[2] // TILE)], columns=[*at, "r", "tile", "z"])

    def two(pdf: pd.DataFrame) -> pd.DataFrame:
        n, tile = int(pdf["n"].iloc[0]), int(pdf["tile"].iloc[0])
        parts = [np.array(z).view(complex).reshape(2, TILE, TILE) for z in pdf.sort_values("r")["z"]]
        back = by_frequency(n, tile * TILE, np.concatenate(parts, axis=1))
        return pd.DataFrame([(*head(pdf), tile, t, _flat(back[:, t * TILE : (t + 1) * TILE])) for t in range(back.shape[1] // TILE)], columns=[*at, "r", "tile", "z"])

    def three(pdf: pd.DataFrame) -> pd.DataFrame:
        n, tile = int(pdf["n"].iloc[0]), int(pdf["tile"].iloc[0])
        got = np.concatenate([np.array(z).view(complex).reshape(TILE, TILE) for z in pdf.sort_values("r")["z"]])
        return pd.DataFrame([(*head(pdf), v) for v in largest(by_place(n, tile * TILE, got), top)], columns=[*at, "value"])

    # R is at least TILE; every tile of remainders has points, as a long series has more than R of them
    tiles = points.withColumn("tile", F.floor(F.pmod("j", _r_size()) / TILE))
    step = f"{own}, r long, tile long, z array<double>"
    return tiles.groupBy(*at, "tile").applyInPandas(one, step).groupBy(*at, "tile").applyInPandas(two, step).groupBy(*at, "tile").applyInPandas(three, f"{own}, value double").drop("n")


def _r_size():
    """R of a row's n, as a column: ``_sizes`` in SQL."""
    bits = F.greatest(F.lit(2 * TILE.bit_length()), F.length(F.regexp_replace(F.bin(2 * F.col("n") - 1), "^0+", "")))
    return F.pow(F.lit(2.0), F.floor(bits / 2)).cast("long")


def spectral_features(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str], top: int = 3, span: int = 3) -> DataFrame:
    """key, measure, n, ema (the exponential average at the series' end), fourier (the largest magnitudes of its
    transform), haar2 (of its second-level Haar details) and wave (of all coefficients of two Haar levels):
    one row for each entity and column, whatever the length. Nulls count as 0; short series are padded with 0.

    They describe a whole series, so they say nothing that a row could have known before its end; for that
    take ``features.wave_features``. The order's first column must be a date, a timestamp or a number."""
    kind, alpha = dict(df.dtypes)[key], 2.0 / (span + 1)
    rows = written(df.select(key, *dict.fromkeys([*order, *cols])), "series")
    placed = scans.row_numbers(rows, [key], order, order[0], "_n")
    told = {f"v{i}": F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)) for i, c in enumerate(cols)}
    values = placed.select(key, (F.col("_n") - 1).alias("j"), *(v.alias(n) for n, v in told.items()), F.floor((F.col("_n") - 1) / CHUNK).alias("chunk"))
    lists = values.groupBy(key, "chunk").agg(F.sort_array(F.collect_list(F.struct("j", *told))).alias("s"))
    of = lambda n: F.transform("s", lambda s: s[n]).alias("x")
    # one list for all columns is sorted and grouped, then each has its own
    chunk = lists.select(key, "chunk", F.inline(F.array(*(F.struct(F.lit(c).alias("measure"), of(n)) for c, n in zip(cols, told, strict=True)))))
    chunks = written(chunk, "chunks")
    several = chunks.filter(F.col("chunk") > 0).select(F.col(key).alias("_k")).distinct()
    if several.isEmpty():
        return _of_one_chunk(chunks, key, alpha, top)
    own = chunks[key].eqNullSafe(several["_k"])
    return _of_one_chunk(chunks.join(several, own, "left_anti"), key, alpha, top).unionByName(_of_several_chunks(chunks.join(several, own, "left_semi"), key, kind, alpha, top))


_FOUND = "ema double, fourier array<double>, haar2 array<double>, wave array<double>"


def _features(df: DataFrame, key: str, top: int) -> DataFrame:
    padded = lambda c: F.slice(F.concat(F.col(c), F.array_repeat(F.lit(0.0), top)), 1, top).alias(c)
    return df.select(key, "measure", "n", "ema", *(padded(c) for c in ("fourier", "haar2", "wave")))


def _of_one_chunk(chunks: DataFrame, key: str, alpha: float, top: int) -> DataFrame:
    """Features of series that are one chunk: where they lie, those of equal length at once."""

    @F.pandas_udf(_FOUND)
    def whole(x: pd.Series) -> pd.DataFrame:
        lists, size = x.to_numpy(), x.map(len).to_numpy()
        out = {c: np.empty(len(x), object) for c in ("ema", "fourier", "haar2", "wave")}
        for n in np.unique(size):
            same = np.flatnonzero(size == n)
            step = max(1, STACK // int(n))
            for at in (same[i : i + step] for i in range(0, len(same), step)):
                v = np.stack(lists[at]).astype(float)
                means, second, first = haar_coefficients(v)
                out["ema"][at] = average_of(v, alpha, True)
                for c, found in (("fourier", np.fft.rfft(v, axis=1)), ("haar2", second), ("wave", np.concatenate((means, second, first), axis=1))):
                    for i, told in zip(at, largest(found, top), strict=True):
                        out[c][i] = told
        return pd.DataFrame(out).astype({"ema": float})

    return _features(chunks.select(key, "measure", F.size("x").cast("long").alias("n"), whole("x").alias("f")).select(key, "measure", "n", "f.*"), key, top)


def _of_several_chunks(chunks: DataFrame, key: str, kind: str, alpha: float, top: int) -> DataFrame:
    """Features of series of several chunks: what each chunk has is grouped by series."""
    sizes = chunks.groupBy(F.col(key).alias("_k"), F.col("measure").alias("_m")).agg(F.sum(F.size("x")).alias("n"))
    sized = chunks.join(sizes, chunks[key].eqNullSafe(sizes["_k"]) & (chunks["measure"] == sizes["_m"])).drop("_k", "_m")

    @F.pandas_udf(_FOUND)
    def inside(x: pd.Series, place: pd.Series, n: pd.Series) -> pd.DataFrame:
        out = []
        for v, c, size in zip(x, place, n, strict=True):
            v = np.asarray(v, float)
            means, second, first = haar_coefficients(v)
            after = int(size) - int(c) * CHUNK - len(v)
            ema = float(average_of(v, alpha, c == 0)) * (1 - alpha) ** after
            out.append((ema, [], largest(second, top), largest(np.concatenate((means, second, first)), top)))
        return pd.DataFrame(out, columns=["ema", "fourier", "haar2", "wave"])

    parts = sized.select(key, "measure", "n", inside("x", "chunk", "n").alias("f")).select(key, "measure", "n", "f.*")
    told = F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("values")) for c in ("fourier", "haar2", "wave")))
    found = parts.select(key, "measure", F.explode(told).alias("t")).select(key, "measure", F.col("t.kind").alias("kind"), F.explode("t.values").alias("value"))
    spectra = _long_spectra(sized, key, kind, top)
    found = found.unionByName(spectra.select(key, "measure", F.lit("fourier").alias("kind"), "value"))
    best = found.withColumn("at", F.row_number().over(Window.partitionBy(key, "measure", "kind").orderBy(F.desc("value")))).filter(F.col("at") <= top)
    listed = best.groupBy(key, "measure").agg(*(F.sort_array(F.collect_list(F.when(F.col("kind") == c, F.col("value"))), asc=False).alias(c) for c in ("fourier", "haar2", "wave")))
    ends = parts.groupBy(F.col(key).alias("_k"), F.col("measure").alias("_m")).agg(F.max("n").alias("n"), F.sum("ema").alias("ema"))
    out = listed.join(ends, listed[key].eqNullSafe(ends["_k"]) & (listed["measure"] == ends["_m"]))
    return _features(out, key, top)
