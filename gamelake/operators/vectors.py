"""Texts as vectors: tf-idf of hashed words and a randomised truncated SVD.

Words are hashed to ``features`` columns, so that the factors have a fixed size (features x rank) whatever the
number of texts. The subspace iteration of Halko, Martinsson and Tropp (2011) needs only products
A'(A Q) with a matrix Q of that size: each pass sends Q to the tasks, each task adds up the product of its
rows, and the products are added by feature. Texts are read once, to count words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.sources.tables import written

SEED = 42
#: Texts whose products with Q are in memory at once.
SLICE = 256


@dataclass(frozen=True)
class TextModel:
    """idf of each feature; components: (features, rank), orthonormal; values: the singular values."""

    idf: np.ndarray
    components: np.ndarray
    values: np.ndarray


def word_counts(df: DataFrame, col: str, features: int) -> DataFrame:
    """df with _ids and _tfs: the hashed words of each text (runs of letters and digits in lower case) and how often
    each is there. Null and empty texts have none."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(col), F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(features)).cast("int"))

    @F.pandas_udf("ids array<int>, tfs array<int>")
    def count(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in parts:
            both = [np.unique(np.asarray(w, np.int32), return_counts=True) for w in part]
            yield pd.DataFrame({"ids": [b[0] for b in both], "tfs": [b[1].astype(np.int32) for b in both]})

    return df.withColumn("_c", count(hashed)).select(*df.columns, F.col("_c.ids").alias("_ids"), F.col("_c.tfs").alias("_tfs"))


def rows_of(batch: pa.RecordBatch, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids, weights (of length one a text) and text numbers of the columns _ids and _tfs."""
    lists = batch.column(batch.schema.get_field_index("_ids"))
    ids, tf = lists.flatten().to_numpy(), batch.column(batch.schema.get_field_index("_tfs")).flatten().to_numpy()
    row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
    w = (1.0 + np.log(tf)) * idf[ids]
    size = np.sqrt(np.bincount(row, w * w, batch.num_rows))
    return ids, w / np.maximum(size, 1e-300)[row], row


def times(ids: np.ndarray, w: np.ndarray, row: np.ndarray, n: int, q: np.ndarray) -> np.ndarray:
    """Rows times q: (n, columns of q)."""
    out = np.zeros((n, q.shape[1]))
    if len(ids):
        first = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        out[row[first]] = np.add.reduceat(w[:, None] * q[ids], first, axis=0)
    return out


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of ``SLICE`` rows: products have a row for each word, so a whole batch of long texts would
    take gigabytes."""
    for first in range(0, batch.num_rows, SLICE):
        yield batch.slice(first, SLICE)


def _product(counts: DataFrame, idf: np.ndarray, q: np.ndarray) -> np.ndarray:
    """A'(A q), added up in the cluster."""
    sent = counts.sparkSession.sparkContext.broadcast((idf, q))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, q = sent.value
        total = np.zeros_like(q)
        for batch in (piece for whole in batches for piece in slices(whole)):
            ids, w, row = rows_of(batch, idf)
            y = times(ids, w, row, batch.num_rows, q)
            order = np.argsort(ids, kind="stable")
            own, first = np.unique(ids[order], return_index=True)
            if len(own):
                total[own] += np.add.reduceat((w[:, None] * y[row])[order], first, axis=0)
        some = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(list(total[some]), pa.list_(pa.float64()))], ["i", "z"])

    parts = counts.select("_ids", "_tfs").mapInArrow(add, "i int, z array<double>")
    sums = parts.groupBy("i").agg(F.array(*(F.sum(F.col("z")[j]) for j in range(q.shape[1]))).alias("z"))
    out = np.zeros_like(q)
    for r in sums.collect():
        out[r["i"]] = r["z"]
    return out


def fit_text_svd(df: DataFrame, col: str, rank: int = 16, features: int = 1 << 14, more: int = 8, passes: int = 3) -> TextModel:
    """tf-idf weights and the leading right singular vectors of all texts, over the whole table. ``more`` columns are
    carried beside rank; each of ``passes`` sharpens them. Signs are such that the largest entry is positive."""
    counts = written(word_counts(df.select(col), col, features).select("_ids", "_tfs"), "words")
    n, idf = counts.filter(F.size("_ids") > 0).count(), np.zeros(features)
    for r in counts.select(F.explode("_ids").alias("i")).groupBy("i").agg(F.count("*").alias("n")).collect():
        idf[r["i"]] = np.log((1.0 + n) / (1.0 + r["n"])) + 1.0
    q = np.linalg.qr(np.random.default_rng(SEED).normal(size=(features, rank + more)))[0]
    for _ in range(passes):
        q = np.linalg.qr(_product(counts, idf, q))[0]
    z = _product(counts, idf, q)
    values, turn = np.linalg.eigh((q.T @ z + z.T @ q) / 2)
    best = np.argsort(-values)[:rank]
    v = q @ turn[:, best]
    v *= np.sign(v[np.abs(v).argmax(0), np.arange(v.shape[1])])
    return TextModel(idf, v, np.sqrt(np.maximum(values[best], 0)))


def embed(df: DataFrame, col: str, model: TextModel, name: str = "vector") -> DataFrame:
    """df with ``vector`` (array of double, length one): each whole text in the space of the model. Texts without
    known words have a vector of zeros."""
    sent = df.sparkSession.sparkContext.broadcast(model)
    counted = word_counts(df, col, len(model.idf))

    @F.pandas_udf("array<double>")
    def told(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = sent.value
        for ids, tfs in parts:
            batch = pa.RecordBatch.from_arrays([pa.array(list(ids), pa.list_(pa.int32())), pa.array(list(tfs), pa.list_(pa.int32()))], ["_ids", "_tfs"])
            v = np.concatenate([np.zeros((0, m.components.shape[1])), *(times(*rows_of(piece, m.idf), piece.num_rows, m.components) for piece in slices(batch))])
            yield pd.Series(list(v / np.maximum(np.sqrt(np.square(v).sum(1, keepdims=True)), 1e-300)))

    return counted.withColumn(name, told("_ids", "_tfs")).drop("_ids", "_tfs")
