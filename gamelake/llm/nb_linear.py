"""Linear text classifiers on hashed character n-grams scaled by naive Bayes log-count ratios.

The scaled indicators follow Wang and Manning (2012). The linear model is fitted by dual coordinate
descent, with the hinge loss (Hsieh et al. 2008) or the logistic loss (Yu, Huang and Lin 2011).

A model is fitted on a bounded sample of labelled rows (``max_rows`` documents of ``max_bytes`` in all,
in the order of a hash of their ids, and ``max_features`` n-grams); it is then at most ``2**bits``
weights, so its size does not depend on the data. Every document is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches


@dataclass(frozen=True)
class Spec:
    """What to fit. ``loss`` is "hinge" (scores by Platt scaling) or "logistic"; n-grams in fewer than
    ``least`` documents of the sample get no weight. ``blank``: white space, and either end of a text,
    is one blank, so that n-grams show where words begin and end."""

    orders: tuple[int, ...]
    loss: str
    bits: int = 18
    lower: bool = True
    blank: bool = False
    alpha: float = 1.0
    cost: float = 1.0
    epochs: int = 20
    least: int = 1
    max_rows: int = 12_000
    max_bytes: int = 48_000_000
    max_features: int = 40_000_000


@dataclass(frozen=True)
class Model:
    """weights: log-count ratio times linear weight of each bucket; score = sigmoid(slope * margin + shift)."""

    spec: Spec
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


class Buckets:
    """Distinct n-gram buckets of a text, in time proportional to its length."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.last = np.zeros(1 << spec.bits, np.int32)

    def __call__(self, text: str | None) -> np.ndarray:
        s = self.spec
        text = (text or "").lower() if s.lower else text or ""
        if s.blank and text:
            text = f" {' '.join(text.split())} "
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found, h = [], codes
        for n in range(1, max(s.orders) + 1):
            if n > 1:
                h = h[:-1] * np.uint32(0x01000193) + codes[n - 1 :]
            if n in s.orders and len(h):
                found.append(((h ^ np.uint32(n * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - s.bits))
            if len(h) < 2:
                break
        if not found:
            return np.empty(0, np.uint32)
        b = np.concatenate(found)
        at = np.arange(len(b), dtype=np.int32)
        self.last[b] = at
        return b[self.last[b] == at]


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray, spec: Spec) -> np.ndarray:
    """Log ratio of the shares of documents of either class that hold the n-gram. The smoothing counts
    are dealt to the classes by their size, so an n-gram that tells nothing has ratio 0."""
    many = np.array([(y == 0).sum(), (y == 1).sum()], float)
    count = np.zeros((2, 1 << spec.bits))
    for row, label in zip(rows, y, strict=True):
        count[int(label)][row] += 1
    share = (count + spec.alpha * (many / many.sum())[:, None]) / many[:, None]
    return np.where(count.sum(0) >= spec.least, np.log(share[1]) - np.log(share[0]), 0.0)


def descend(rows: list[np.ndarray], y: np.ndarray, ratios: np.ndarray, spec: Spec) -> tuple[np.ndarray, float]:
    """Weights and bias by dual coordinate descent, one document at a time in a random order."""
    sign = np.where(y > 0, 1.0, -1.0)
    norm = np.array([np.square(ratios[r]).sum() + 1.0 for r in rows])
    w, bias = np.zeros(len(ratios)), 0.0
    upper = spec.cost * (len(y) / (2.0 * np.maximum(1, np.where(y > 0, (y > 0).sum(), (y == 0).sum()))) if spec.loss == "hinge" else np.ones(len(y)))
    alpha = np.zeros(len(y)) if spec.loss == "hinge" else np.minimum(1e-3 * upper, 1e-8)
    if spec.loss != "hinge":
        for r, a, s in zip(rows, alpha, sign, strict=True):
            w[r] += a * s * ratios[r]
            bias += a * s
    rng = np.random.default_rng(42)
    for _ in range(spec.epochs):
        most = 0.0
        for i in rng.permutation(len(y)):
            r, c, a = rows[i], upper[i], alpha[i]
            v = ratios[r]
            m = sign[i] * (w[r] @ v + bias)
            if spec.loss == "hinge":
                new = min(max(a - (m - 1.0) / norm[i], 0.0), c)
            else:  # minimise  z log z + (c - z) log(c - z) + q/2 (z - a)^2 + m (z - a)  by Newton steps
                new = a
                for _ in range(12):
                    grad = np.log(new / (c - new)) + m + norm[i] * (new - a)
                    step = grad / (c / (new * (c - new)) + norm[i])
                    if new - step <= 0:
                        new *= 0.1
                    elif new - step >= c:
                        new = c - 0.1 * (c - new)
                    else:
                        new -= step
                    if abs(grad) < 1e-3:
                        break
            if new != a:
                w[r] += (new - a) * sign[i] * v
                bias += (new - a) * sign[i]
                alpha[i] = new
                most = max(most, abs(new - a) * norm[i])
        if most < 1e-2:  # the largest change of a margin that one step made
            break
    return w, bias


def _telling(rows: list[np.ndarray], ratios: np.ndarray) -> list[np.ndarray]:
    """The rows without n-grams of ratio 0, which have no part in any margin; as they are where that
    would leave most of them, so that no second copy of the sample is held for little."""
    kept = [int(np.count_nonzero(ratios[r])) for r in rows]
    if sum(kept) > 0.7 * sum(map(len, rows)):
        return rows
    flat, ends = np.empty(sum(kept), np.int32), np.cumsum([0, *kept])
    for r, a, z in zip(rows, ends[:-1], ends[1:], strict=True):
        flat[a:z] = r[ratios[r] != 0]
    return [flat[a:z] for a, z in zip(ends[:-1], ends[1:], strict=True)]


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the sigmoid that fits y best (Platt's targets, Newton steps)."""
    pos, neg = (y > 0).sum(), (y == 0).sum()
    t = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, np.log((pos + 1) / (neg + 1))
    x = np.stack([margin, np.ones_like(margin)], 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ (a, b), -500, 500)))
        grad = x.T @ (p - t) + 1e-3 * np.array([a - 1, 0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def fit_rows(rows: list[np.ndarray], y: np.ndarray, spec: Spec) -> Model:
    """With one class or no row at all the score is the smoothed share of label 1."""
    if len(set(y.tolist())) < 2:
        share = (y.sum() + 1) / (len(y) + 2)
        return Model(spec, np.zeros(1 << spec.bits, np.float32), 0.0, 1.0, float(np.log(share / (1 - share))))
    slope, shift = 1.0, 0.0
    if spec.loss == "hinge":  # margins on rows that the scaled model has not seen
        margins = np.empty(len(y))
        for k in range(3):
            out = np.arange(len(y)) % 3 == k
            inside = [r for r, o in zip(rows, out, strict=True) if not o]
            if len(set(y[~out].tolist())) < 2:
                margins[out] = 0.0
                continue
            ratios = log_count_ratios(inside, y[~out], spec)
            w, bias = descend(_telling(inside, ratios), y[~out], ratios, spec)
            v = w * ratios
            margins[out] = [v[r].sum() + bias for r, o in zip(rows, out, strict=True) if o]
        slope, shift = platt(margins, y)
    ratios = log_count_ratios(rows, y, spec)
    w, bias = descend(_telling(rows, ratios), y, ratios, spec)
    return Model(spec, (w * ratios).astype(np.float32), float(bias), slope, shift)


def sample_of(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, spec: Spec) -> DataFrame:
    """order, key, label and text of the labelled documents to fit on: in the order of a hash of the key,
    as many as max_rows and max_bytes (of UTF-8) allow; texts of over a sixteenth of max_bytes are left out.

    Sizes are summed up before any text moves, so no task gets more than max_bytes of text. Of several
    rows with one key the text with the smallest hash counts, once."""
    ids = (
        labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).cast("int").alias("label"))
        .select("key", "label", F.xxhash64("key").alias("order"))
        .orderBy("order", "key")
        .limit(spec.max_rows)
    )
    own = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumns({"hash": F.xxhash64("text"), "size": F.octet_length("text")})
    sized = own.join(F.broadcast(ids), "key").groupBy("order", "key", "label").agg(F.min(F.struct("hash", "size")).alias("t")).select("order", "key", "label", "t.*")
    # at most max_rows rows, of numbers only
    sums = F.sum("size").over(Window.partitionBy().orderBy("order", "key"))
    fits = sized.filter(F.col("size") <= spec.max_bytes // 16).withColumn("sum", sums).filter(F.col("sum") <= spec.max_bytes).select("order", "key", "label", "hash")
    return own.join(F.broadcast(fits), ["key", "hash"]).groupBy("order", "key", "label").agg(F.first("text").alias("text"))


def fit(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str, spec: Spec) -> Model:
    """Fit on labelled documents. Labels other than 0 and 1 are left out; a key labelled twice counts
    with its larger label. Null texts are empty ones. One task gets the n-gram buckets of the sample,
    which ``sample_of`` bounds where texts are read."""
    bounded_batches(docs.sparkSession)
    chosen = sample_of(docs, labels, text, key, label, spec)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets = Buckets(spec)
        for batch in batches:
            ids = [buckets(t).astype(np.int32) for t in batch.column("text").to_pylist()]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate([np.empty(0, np.int32), *ids])))
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("key"), batch.column("label"), lists], ["order", "key", "label", "ids"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, y, size = [], [], 0
        whole = np.empty(spec.max_features, np.int32)  # pages are taken as they are filled, and given back as one
        for batch in batches:
            lists, given = batch.column("ids"), batch.column("label").to_pylist()
            flat, ends = lists.values.to_numpy(), lists.offsets.to_numpy()
            for i, lab in enumerate(given):
                n = int(ends[i + 1] - ends[i])
                if size + n <= spec.max_features:
                    whole[size : size + n] = flat[ends[i] : ends[i + 1]]
                    rows.append(whole[size : size + n])
                    y.append(lab)
                    size += n
        m = fit_rows(rows, np.array(y, dtype=np.int64), spec)
        yield pa.RecordBatch.from_pydict({"weights": [m.weights.tobytes()], "bias": [m.bias], "slope": [m.slope], "shift": [m.shift]})

    kind = dict(chosen.dtypes)["key"]
    got = (
        chosen.mapInArrow(featurise, f"order long, key {kind}, label int, ids array<int>")
        .repartition(1)
        .sortWithinPartitions("order", "key")
        .mapInArrow(learn, "weights binary, bias double, slope double, shift double")
        .collect()
    )
    if not got:
        return fit_rows([], np.empty(0, np.int64), spec)
    return Model(spec, np.frombuffer(got[0].weights, np.float32), got[0].bias, got[0].slope, got[0].shift)


def score(text: Column, model: Model, df: DataFrame) -> Column:
    """Probability of label 1 for each whole text; null texts are empty ones."""
    bounded_batches(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        buckets = Buckets(m.spec)
        for part in parts:
            margin = np.array([m.weights[buckets(t)].sum(dtype=np.float64) + m.bias for t in part], dtype=np.float64)
            yield pd.Series(1 / (1 + np.exp(-np.clip(m.slope * margin + m.shift, -500, 500))))

    return scored(text)
