"""Language identification (operator 7) by interpolated Kneser-Ney character models.

One model per language, fitted on a bounded sample of its labelled documents: continuation counts
below the highest order, one discount per order from the counts of ones and twos. A model is a pair
of sorted hash arrays per order (n-grams with their discounted share, contexts with the weight they
pass down), so it is at most a few times ``max_chars`` entries long, whatever the corpus. The language
with the lowest cross-entropy per character is chosen. The score's temperature and the entropy from
which a text is rejected are calibrated on sampled documents that the models have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gamelake.llm.common import bounded_batches, fold, materialise

#: Languages up to which the table of their counts is broadcast (under 1 MB).
BROADCAST_LANGUAGES = 10_000
#: Characters that are scored in one call.
TOGETHER = 1 << 18
MULTIPLIER, BLANK, VOCABULARY = np.uint64(0x9E3779B97F4A7C15), 32, 65_536


@dataclass(frozen=True)
class Spec:
    """order: characters of an n-gram. max_docs and max_chars bound each language's sample (texts of over
    a sixteenth of max_chars are left out of it)."""

    order: int = 5
    max_docs: int = 1_500
    max_chars: int = 2_000_000
    slots: int = 1 << 20


@dataclass(frozen=True)
class Order:
    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    passes: np.ndarray


@dataclass(frozen=True)
class Models:
    spec: Spec
    orders: dict[str, list[Order]] = field(default_factory=dict)
    sharpness: float = 1.0
    limits: dict[str, float] = field(default_factory=dict)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Each BMP character as its lower-case letter, others as a blank."""
    out = np.full(VOCABULARY, BLANK, np.uint16)
    for c in range(VOCABULARY):
        if chr(c).isalpha():
            low = ord(chr(c).lower()[0])
            out[c] = low if chr(low).isalpha() else c
    return out


def normal(text: str | None) -> np.ndarray:
    """Letters in lower case, one blank for anything between them; empty if there is no letter."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = codes >= VOCABULARY
    if wide.any():  # letters beyond the BMP share a few private codes
        far = np.fromiter((chr(c).isalpha() for c in codes[wide].tolist()), bool, int(wide.sum()))
        plain = letters()[np.where(wide, 0, codes)].copy()
        plain[np.flatnonzero(wide)[far]] = (0xE000 + codes[wide][far] % 0x1000).astype(np.uint16)
    else:
        plain = letters()[codes]
    blank = plain == BLANK
    if blank.all():
        return np.empty(0, np.uint16)
    return plain[~(blank & np.concatenate(([True], blank[:-1])))]


def gram_hashes(plain: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams that end at each character, for n from 1 to order; blanks stand before the text."""
    c = np.concatenate((np.full(order - 1, BLANK, np.uint64), plain.astype(np.uint64)))
    out, h = [], np.zeros(len(c), np.uint64)
    for n in range(1, order + 1):
        # the gram of n characters from each place; it ends n - 1 places later
        h = c[: len(c) - n + 1] + np.uint64(1) if n == 1 else h[: len(c) - n + 1] * MULTIPLIER + c[n - 1 :] + np.uint64(1)
        out.append(h)
    return out


def fit_language(texts: list[np.ndarray], order: int) -> list[Order]:
    """Interpolated Kneser-Ney shares, lowest order first."""
    hashed = [gram_hashes(p, order) for p in texts if len(p)]
    cat = lambda n, cut: np.concatenate([np.empty(0, np.uint64), *(cut(h[n - 1]) for h in hashed)])
    out: list[Order] = []
    at = None
    # occurrences at each character of the text: grams that end there
    ends = lambda n: cat(n, lambda h: h[order - n :])
    contexts_of = lambda n: np.concatenate([np.empty(0, np.uint64), *((h[n - 2][order - n : len(h[n - 2]) - 1] if n > 1 else np.zeros(len(h[0]) - order + 1, np.uint64)) for h in hashed)])
    for n in range(order, 0, -1):
        seen, first, count = np.unique(ends(n), return_index=True, return_counts=True)
        if n < order:  # how many different characters stand before the gram, from the distinct longer ones
            count = np.bincount(np.searchsorted(seen, ends(n)[at]), minlength=len(seen))
        ctx, back = np.unique(contexts_of(n)[first], return_inverse=True)
        total, kinds = np.bincount(back, count), np.bincount(back)
        ones, twos = (count == 1).sum(), (count == 2).sum()
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        out.append(Order(seen, (np.maximum(count - d, 0) / total[back]).astype(np.float32), ctx, (d * kinds / total).astype(np.float32)))
        at = first
    return out[::-1]


def probabilities(orders: list[Order], hashes: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
    """Probability of each character; hashes[n-1]: its n-gram, contexts[n-1]: the n - 1 characters before it."""

    def look(keys: np.ndarray, values: np.ndarray, asked: np.ndarray, other: float) -> np.ndarray:
        if not len(keys):
            return np.full(len(asked), other)
        k = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
        return np.where(keys[k] == asked, values[k].astype(np.float64), other)

    p = np.full(len(hashes[0]), 1.0 / VOCABULARY)
    for o, h, c in zip(orders, hashes, contexts, strict=True):
        p = look(o.grams, o.shares, h, 0.0) + look(o.contexts, o.passes, c, 1.0) * p
    return p


class Scorer:
    """Cross-entropy of texts under each language, with a table of n-grams scored before."""

    def __init__(self, models: Models):
        self.m, self.names = models, sorted(models.orders)
        slots = max(1 << 12, models.spec.slots // max(1, len(self.names) // 8))
        self.shift = np.uint64(64 - (slots.bit_length() - 1))
        self.keys = np.zeros(1 << (slots.bit_length() - 1), np.uint64)
        self.bits = np.zeros((len(self.keys), len(self.names)), np.float32)

    def _fresh(self, parts: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
        return np.stack([-np.log2(probabilities(self.m.orders[n], parts, contexts)) for n in self.names], 1).astype(np.float32)

    def entropies(self, texts: list[np.ndarray]) -> np.ndarray:
        """(texts, languages): bits per character; infinite for texts without a letter. Texts are scored
        together up to TOGETHER characters, so that the cost of a call is shared."""
        out = np.full((len(texts), len(self.names)), np.inf)
        part: list[int] = []
        size = 0
        for i, plain in enumerate(texts):
            if len(plain) and self.names:
                part.append(i)
                size += len(plain)
            if part and (size >= TOGETHER or i == len(texts) - 1):
                out[part] = self._together([texts[k] for k in part])
                part, size = [], 0
        return out

    def _together(self, texts: list[np.ndarray]) -> np.ndarray:
        n = self.m.spec.order
        each = [gram_hashes(t, n) for t in texts]
        # the n-grams that end at each character, for n from 1 on
        hashed = [np.concatenate([h[k - 1][n - k :] for h in each]) for k in range(1, n + 1)]
        before = [np.concatenate([h[k - 2][n - k : -1] for h in each]) for k in range(2, n + 1)]
        full = hashed[-1]
        slot = (full * np.uint64(0xD6E8FEB86659FD93)) >> self.shift
        known = self.keys[slot] == full
        bits = self.bits[slot]
        if not known.all():
            new, first = np.unique(full[~known], return_index=True)
            at = np.flatnonzero(~known)[first]
            got = self._fresh([h[at] for h in hashed], [np.zeros(len(at), np.uint64), *(c[at] for c in before)])
            bits[~known] = got[np.searchsorted(new, full[~known])]
            self.keys[slot[at]], self.bits[slot[at]] = new, got
        ends = np.cumsum([len(t) for t in texts])
        return np.add.reduceat(bits.astype(np.float64), ends - [len(t) for t in texts], axis=0) / np.array([[len(t)] for t in texts])


def posterior(entropy: np.ndarray, chars: np.ndarray, sharpness: float) -> np.ndarray:
    x = -sharpness * np.sqrt(chars)[:, None] * entropy
    x -= x.max(1, keepdims=True)
    e = np.exp(x)
    return e / e.sum(1, keepdims=True)


def fit(docs: DataFrame, spec: Spec = Spec()) -> Models:
    """Models from documents with a language outside the held-out quarter. The sample is, for each
    language, the max_docs documents with the smallest hashes of their ids, as far as max_chars allows; a
    fifth of it calibrates. Of an id's rows in a language the text with the smallest hash counts, once, so
    repeated rows change nothing. Rows without an id, a text or a language take no part; a table without any
    other gives models of no language. Other columns are not read."""
    spark = docs.sparkSession
    bounded_batches(spark)
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), 4) != 2))
    ids = known.select("doc_id", "lang").distinct().withColumn("order", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    # only hashes that can be among the smallest go to the ranking, however common a language is
    many = materialise(ids.groupBy("lang").agg(F.count("*").alias("many")), "languages")
    if many.count() <= BROADCAST_LANGUAGES:  # else joined by shuffle
        many = F.broadcast(many)
    low = ids.join(many, "lang").filter(F.col("order") / float(2**63) < 2.0 * spec.max_docs / F.col("many"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    sample = low.withColumn("n", rank).filter(F.col("n") <= spec.max_docs).select("doc_id", "lang", "order", "n")
    # sizes are summed up before any text moves: a language's task gets max_chars at most
    own = known.select("doc_id", "lang", "text").withColumns({"hash": F.xxhash64("text"), "size": F.length("text")})
    sized = own.join(F.broadcast(sample), ["doc_id", "lang"]).groupBy("lang", "n", "order", "doc_id").agg(F.min(F.struct("hash", "size")).alias("t")).select("lang", "n", "order", "doc_id", "t.*")
    sums = F.sum("size").over(Window.partitionBy("lang", F.col("n") % 5 == 0).orderBy("n", "doc_id"))
    fits = sized.filter(F.col("size") <= spec.max_chars // 16).withColumn("sum", sums).filter(F.col("sum") <= spec.max_chars).select("doc_id", "lang", "hash", "n", "order")
    chosen = own.join(F.broadcast(fits), ["doc_id", "lang", "hash"]).groupBy("doc_id", "lang", "n", "order").agg(F.first("text").alias("text"))

    def learn(pdf: pd.DataFrame) -> pd.DataFrame:
        found = fit_language([normal(t) for t in pdf.sort_values(["order", "doc_id"])["text"]], spec.order)
        return pd.DataFrame(
            [(pdf["lang"].iloc[0], k, o.grams.tobytes(), o.shares.tobytes(), o.contexts.tobytes(), o.passes.tobytes()) for k, o in enumerate(found)],
            columns=["lang", "k", "grams", "shares", "contexts", "passes"],
        )

    rows = chosen.filter("n % 5 <> 0").groupBy("lang").applyInPandas(learn, "lang string, k int, grams binary, shares binary, contexts binary, passes binary").collect()
    orders: dict[str, list[Order]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["k"])):
        orders.setdefault(r["lang"], []).append(Order(np.frombuffer(r["grams"], np.uint64), np.frombuffer(r["shares"], np.float32), np.frombuffer(r["contexts"], np.uint64), np.frombuffer(r["passes"], np.float32)))
    models = Models(spec, orders)
    if not orders:
        return models
    sent = spark.sparkContext.broadcast(models)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value)
        for batch in batches:
            plain = [normal(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array([len(p) for p in plain], pa.int32()), pa.array(scorer.entropies(plain).tolist(), pa.list_(pa.float64()))], ["lang", "chars", "entropy"])

    seen = [r for r in chosen.filter("n % 5 = 0").select("lang", "text").mapInArrow(measure, "lang string, chars int, entropy array<double>").collect() if r["chars"] and r["lang"] in orders]
    if not seen:
        return models
    names = sorted(orders)
    truth = np.array([names.index(r["lang"]) for r in seen])
    entropy, chars = np.array([r["entropy"] for r in seen]), np.array([r["chars"] for r in seen], float)
    tried = 2.0 ** np.arange(-6, 8)
    loss = [-np.log(np.maximum(posterior(entropy, chars, t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in tried]
    own = entropy[np.arange(len(truth)), truth]
    limits = {n: float(np.quantile(own[truth == k], 0.99) + 3 * own[truth == k].std()) for k, n in enumerate(names) if (truth == k).any()}
    return Models(spec, orders, float(tried[int(np.argmin(loss))]), limits)


def identify(docs: DataFrame, models: Models) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1), rejected (the entropy is above the language's
    calibrated limit, so the text is likely of no learned language): one row per row of docs.

    Texts that are null or have no letter are "und" with score 0, not rejected; so are all texts if no
    language was learned. Ties go to the language that sorts first. Null ids are not held out. Repeated
    rows are told alike, one row each. An empty table gives an empty one; other columns are left out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(models)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def told(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(sent.value)
        for part in parts:
            plain = [normal(t) for t in part]
            chars = np.array([len(p) for p in plain], float)
            out = pd.DataFrame({"lang_pred": np.full(len(plain), "und", object), "score": 0.0, "rejected": False})
            some = np.flatnonzero(chars)
            if len(some) and scorer.names:
                e = scorer.entropies([plain[i] for i in some])
                best = e.argmin(1)
                out.loc[some, "lang_pred"] = np.array(scorer.names, object)[best]
                out.loc[some, "score"] = posterior(e, chars[some], sent.value.sharpness)[np.arange(len(some)), best]
                limit = np.array([sent.value.limits.get(n, np.inf) for n in scorer.names])
                out.loc[some, "rejected"] = e[np.arange(len(some)), best] > limit[best]
            yield out

    return docs.select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), told("text").alias("t")).select("doc_id", "held_out", "t.*")
