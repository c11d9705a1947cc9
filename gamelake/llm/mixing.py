"""Mixing sources to target weights (operator 4) by Poisson replication, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import fresh

SEED = 42
#: A source may be repeated any number of times on average; a mean above this is drawn as a sum of
#: independent Poisson counts, each with a mean of at most this, so that exp(-mean) never underflows.
PART = 16.0
#: Sources up to which the table of means is broadcast (at most about 1 MB); beyond, it is joined by shuffle.
BROADCAST_SOURCES = 10_000
UNITS = float(16**13)


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the MD5 of the parts, 52 bits of it."""
    return (F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("double") + 0.5) / UNITS


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The smallest count whose Poisson distribution function reaches u, by summing its terms; the
    terms end where the rest of the tail is far below the resolution of u."""
    terms = F.sequence(F.lit(1), (mean + 12.0 * F.sqrt(mean) + 40.0).cast("int"))
    start = F.struct(F.lit(0).alias("count"), F.exp(-mean).alias("term"), F.exp(-mean).alias("total"))
    # once total reaches u the state stays as it is
    step = lambda s, k: F.when(s["total"] >= u, s).otherwise(F.struct(k.alias("count"), (s["term"] * mean / k).alias("term"), (s["total"] + s["term"] * mean / k).alias("total")))
    return F.aggregate(terms, start, step, lambda s: s["count"])


def repetition_rates(docs: DataFrame, group: str, weights: DataFrame | None = None, size: float | None = None) -> DataFrame:
    """group, rate: the mean number of times each document of a source is taken so that the sources'
    shares are as their weights. weights: (group, weight), by default equal; sources without a weight
    or with a weight of zero or below are left out; the weights of a source that is there twice are added.
    size: documents in the mix, by default as many as there are. A null source is a source; empty tables give
    no rows."""
    counts = docs.groupBy(group).agg(F.count("*").alias("n"))
    if weights is None:
        shared = counts.withColumn("weight", F.lit(1.0))
    else:
        w = weights.groupBy(F.col(group).alias("w_group")).agg(F.sum(F.col("weight").cast("double")).alias("weight"))
        shared = counts.join(w, counts[group].eqNullSafe(w["w_group"])).filter("weight > 0").select(group, "n", "weight")
    weights_sum = shared.agg(F.sum("weight")).first()[0] or 1.0
    wanted = float(counts.agg(F.sum("n")).first()[0] or 0) if size is None else float(size)
    return shared.select(group, (F.lit(wanted) * F.col("weight") / F.lit(float(weights_sum)) / F.col("n")).alias("rate"))


def mix(docs: DataFrame, group: str = "source", weights: DataFrame | None = None, size: float | None = None, seed: int = SEED, added: tuple[str, str] = ("copy", "mix_key")) -> DataFrame:
    """Each document as often as its Poisson count says, in a random order over all partitions.

    Added columns (``added``): copy (from 1) and mix_key, a hash that orders the whole mix. The counts depend on
    seed, doc_id and the rates only; rows with the same id get the same count. Null sources are one
    source; null ids count as the text "null". Null and empty texts are kept like others. An empty
    table gives an empty one. Columns of docs with the added names are replaced."""
    rates = repetition_rates(docs, group, weights, size)
    g, rate, times = fresh(docs, "rate_group", "rate", "times")
    rates = rates.select(F.col(group).alias(g), F.col("rate").alias(rate))
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    parts = F.greatest(F.lit(1), F.ceil(F.col(rate) / PART)).cast("int")
    one = lambda j: poisson_inverse(uniform(F.lit(str(seed)), ident, j.cast("string")), F.col(rate) / parts)
    count = F.aggregate(F.transform(F.sequence(F.lit(1), parts), one), F.lit(0), lambda a, b: a + b)
    taken = docs.drop(*added).join(rates, docs[group].eqNullSafe(F.col(g)))
    columns = [c for c in docs.columns if c not in added]
    copies = taken.withColumn(times, count).filter(F.col(times) > 0).select(*columns, F.explode(F.sequence(F.lit(1), F.col(times))).alias(added[0]))
    mixed = copies.withColumn(added[1], F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit("order"), ident, F.col(added[0]).cast("string"))))
    return mixed.repartition(added[1]).sortWithinPartitions(added[1])
