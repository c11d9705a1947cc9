"""Ordered work on keys of any size: segmented scans.

A window by key puts a key's whole history into one task. Here a key is cut into segments at quantiles of
the leading order column, each (key, segment) is a window of its own, a few values of each segment are
scanned in order (a row for each segment, at most ``MOST_CUTS`` + 1 a key), and what they carry is joined
to the segment's rows. A third of all rows under one key is then spread over as many tasks as there are
segments; rows that share a value of the leading column stay together.

Only keys with more than ``WHOLE`` rows are cut (``by_size``): the others, most often all, are one window each,
whose rows meet no segment's totals and stay where they are for what follows by key.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.operators import windows
from gamelake.sources.tables import written

#: Cuts at most; they are literals in the plan.
MOST_CUTS = 127
#: Days from the first cut to the last that a table of days has at most.
MOST_DAYS = 20_000
#: Rows of a key that one window takes.
WHOLE = 100_000


def number(df: DataFrame, by: str) -> Column:
    """The column as a double in the same order: dates, timestamps and numbers."""
    kind = df.schema[by].dataType.simpleString()
    if kind == "date":
        return F.unix_date(F.col(by)).cast("double")
    if kind.startswith("timestamp"):
        return F.col(by).cast("timestamp").cast("double")
    if kind == "string":
        raise TypeError(f"{by}: cut by a date, a timestamp or a number")
    return F.col(by).cast("double")


def cut_points(df: DataFrame, by: str, parts: int | None = None) -> list[float]:
    """Rising approximate quantiles of a column, which cut df into ``parts`` (by default as many as shuffles have
    partitions): one aggregate, whose numbers come to the driver so that all uses of them agree."""
    parts = min(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_CUTS + 1)
    if parts < 2:
        return []
    x = number(df, by)
    found = df.agg(F.percentile_approx(F.when(~F.isnan(x), x), [k / parts for k in range(1, parts)], 1000)).first()[0]
    return sorted(set(found or ()))


def by_size(df: DataFrame, keys: Sequence[str], run: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """run(rows, parts) with one part for the keys of at most ``WHOLE`` rows and with as many as shuffles have
    partitions for those with more. df is read once more, to count."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if not keys:
        return run(df, parts)
    large = written(df.groupBy(*(F.col(k).alias(f"_l{i}") for i, k in enumerate(keys))).agg(F.count("*").alias("_n")).filter(F.col("_n") > WHOLE), "large")
    if large.isEmpty():
        return run(df, 1)
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(F.col(f"_l{i}"))
    few = F.broadcast(large.drop("_n"))  # a row for WHOLE rows of df at most
    return run(df.join(few, same, "left_anti"), 1).unionByName(run(df.join(few, same, "left_semi"), parts))


def segment(x: Column, cuts: Sequence[float], first: int = 0) -> Column:
    """How many cuts are smaller than x, by halving; null is before all."""
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(x > cuts[half], segment(x, cuts[half + 1 :], first + half + 1)).otherwise(segment(x, cuts[:half], first))


def segmented(df: DataFrame, keys: Sequence[str], by: str, cuts: Sequence[float]) -> DataFrame:
    """df with _key (a struct, so that null keys are equal) and _seg."""
    key = F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("_"))
    if cuts and dict(df.dtypes)[by] == "date":  # by a table of days: halving in a wide stage is longer than the JVM compiles
        first, last = int(cuts[0]), int(cuts[-1]) + 1
        if last - first <= MOST_DAYS:
            upto = [bisect_left(cuts, day) for day in range(first, last + 1)]
            place = F.greatest(F.lit(0), F.least(F.unix_date(F.col(by)) - first, F.lit(last - first)))
            return df.withColumns({"_key": key, "_seg": F.coalesce(F.get(F.lit(upto), F.when(F.col(by).isNotNull(), place)), F.lit(0))})
    return df.withColumns({"_key": key, "_seg": segment(number(df, by), cuts)})


def _local() -> WindowSpec:
    """A key's segment."""
    return Window.partitionBy("_key", "_seg")


def _across() -> WindowSpec:
    """A key's segments, a row each."""
    return Window.partitionBy("_key").orderBy("_seg")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by: str, sums: Mapping[str, Column], parts: int | None = None) -> DataFrame:
    """df with the running sum of each column of ``sums``, from a key's first row to this one. ``by`` leads the
    order; without keys the sums run over the whole table. Nulls count as 0."""
    if parts is None:
        return by_size(df, keys, lambda rows, some: running_sums(rows, keys, order, by, sums, some))
    if parts == 1:
        whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({n: F.sum(F.coalesce(c, F.lit(0))).over(whole) for n, c in sums.items()})
    cut = segmented(df, keys, by, cut_points(df, by, parts))
    upto = _local().orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({n: F.sum(F.coalesce(c, F.lit(0))).over(upto) for n, c in sums.items()})
    before = _across().rowsBetween(Window.unboundedPreceding, -1)
    totals = cut.groupBy("_key", "_seg").agg(*(F.sum(F.coalesce(c, F.lit(0))).alias(f"_{n}") for n, c in sums.items()))
    base = totals.select("_key", "_seg", *(F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}") for n in sums))
    return local.join(base, ["_key", "_seg"]).withColumns({n: F.col(n) + F.col(f"_{n}") for n in sums}).drop("_key", "_seg", *(f"_{n}" for n in sums))


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by: str, name: str = "n", parts: int | None = None) -> DataFrame:
    """df with each row's number (from 1) in the order of its key."""
    return running_sums(df, keys, order, by, {name: F.lit(1).cast("long")}, parts)


def block_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by: str, attrs: Sequence[str], name: str = "block", parts: int | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """df with the number (from 1) of the row's block of equal attributes in its key's order; nulls compare as
    values. Segments compare their first attributes with the last ones before them. ``cuts``: those to use."""
    if parts is None and cuts is None:
        return by_size(df, keys, lambda rows, some: block_ids(rows, keys, order, by, attrs, name, some))
    if parts == 1 and cuts is None:
        return windows.block_id(windows.change_flag(df, keys, order, attrs, "_change"), keys, order, "_change", name).drop("_change")
    cut = segmented(df, keys, by, cut_points(df, by, parts) if cuts is None else cuts)
    w = _local().orderBy(*order)
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.lag(a).over(w))
    first = F.row_number().over(w) == 1
    marked = cut.withColumns({"_first": first, "_last": F.lead(F.lit(1)).over(w).isNull(), "_change": F.when(first | same, 0).otherwise(1)})
    marked = marked.withColumn(name, F.sum("_change").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    own = F.struct(*(F.col(a).alias(f"a{i}") for i, a in enumerate(attrs)))
    ends = marked.groupBy("_key", "_seg").agg(F.sum("_change").alias("n"), F.first(F.when(F.col("_first"), own), ignorenulls=True).alias("head"), F.first(F.when(F.col("_last"), own), ignorenulls=True).alias("tail"))
    goes_on = F.row_number().over(_across()) > 1
    for i in range(len(attrs)):
        goes_on = goes_on & F.col(f"head.a{i}").eqNullSafe(F.lag(f"tail.a{i}").over(_across()))
    opened = ends.select("_key", "_seg", "n", F.when(goes_on, 0).otherwise(1).alias("opens"))
    base = opened.select("_key", "_seg", (F.sum(F.col("n") + F.col("opens")).over(_across().rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("_base"))
    return marked.join(base, ["_key", "_seg"]).withColumn(name, F.col(name) + F.col("_base")).drop("_key", "_seg", "_first", "_last", "_change", "_base")


def last_before(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by: str, value: str, name: str, cuts: Sequence[float]) -> DataFrame:
    """df with the last value that isn't null up to this row in its key's order."""
    if not cuts:
        return df.withColumn(name, F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    cut = segmented(df, keys, by, cuts)
    upto = _local().orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumn(name, F.last(value, ignorenulls=True).over(upto))
    ends = cut.filter(F.col(value).isNotNull()).groupBy("_key", "_seg").agg(F.max(F.struct(*order, value))[value].alias("_last"))
    carried = cut.select("_key", "_seg").distinct().join(ends, ["_key", "_seg"], "left")
    carried = carried.select("_key", "_seg", F.last("_last", ignorenulls=True).over(_across().rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    return local.join(carried.filter(F.col("_carried").isNotNull()), ["_key", "_seg"], "left").withColumn(name, F.coalesce(name, "_carried")).drop("_key", "_seg", "_carried")


#: Values whose averages one product with a triangular matrix gives.
_BLOCK = 64


def folded(x: np.ndarray, alpha: float, before: float) -> np.ndarray:
    """s[i] = alpha x[i] + (1 - alpha) s[i - 1], with s[-1] = before: blocks by a triangular matrix, then from block
    to block."""
    keep, n = 1.0 - alpha, len(x)
    steps = np.arange(_BLOCK)
    weights = np.where(steps[:, None] >= steps, alpha * keep ** np.maximum(steps[:, None] - steps, 0), 0.0)
    out = np.append(x, np.zeros(-n % _BLOCK)).reshape(-1, _BLOCK) @ weights.T
    fade = keep ** (steps + 1.0)
    for row in out:
        row += fade * before
        before = row[-1]
    return out.ravel()[:n]


def _folded_rows(marked: DataFrame, alpha: float) -> DataFrame:
    """Ordered rows with _x and _opens (the first of a window), and with _own, the average from zero on up to the
    row, and _many, the values in it."""
    schema = T.StructType([*marked.schema.fields, T.StructField("_own", T.DoubleType()), T.StructField("_many", T.LongType())])

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, many = 0.0, 0
        for batch in batches:
            x = batch.column(batch.schema.get_field_index("_x")).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(batch.column(batch.schema.get_field_index("_opens")).to_numpy(zero_copy_only=False))
            own, count = np.empty(len(x)), np.empty(len(x), np.int64)
            for at, (a, z) in enumerate(zip(np.append(0, edges), np.append(edges, len(x)), strict=True)):
                if at:  # what comes before the first edge goes on from the last batch
                    last, many = 0.0, 0
                there = ~np.isnan(x[a:z])
                count[a:z] = many + np.cumsum(there)
                got = np.append(last, folded(x[a:z][there], alpha, last))
                own[a:z] = got[np.cumsum(there)]
                if z > a:
                    last, many = got[-1], int(count[z - 1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own), pa.array(count)], [*batch.schema.names, "_own", "_many"])

    return marked.mapInArrow(fold, schema)


def ema(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], by: str, col: str, span: int = 3, digits: int = 6, parts: int | None = None) -> DataFrame:
    """df with the exponential moving average of each row, s = a x + (1 - a) s' with a = 2 / (span + 1), from the
    key's first value on; null values leave it as it is. One pass whatever the span: rows go by in order, a
    batch at a time, each segment from zero on; what came before a segment is added to its rows by the
    weight that is left of it. (``windows.ema`` looks back some 22 times its span at every row.)"""
    if parts is None:
        return by_size(df, keys, lambda rows, some: ema(rows, keys, order, by, col, span, digits, some))
    alpha, name = 2.0 / (span + 1), f"{col}_ema{span}"
    left = lambda n: F.pow(F.lit(1.0 - alpha), n.cast("double"))
    value = F.col(col).cast("double")
    x, opens = F.when(~F.isnan(value), value), lambda w: F.row_number().over(w) == 1
    if parts == 1:
        w = Window.partitionBy(*keys).orderBy(*order)
        first = F.first(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
        done = _folded_rows(df.withColumns({"_x": x, "_opens": opens(w), "_first": first}), alpha)
        return done.withColumn(name, F.when(F.col("_many") > 0, F.round(F.col("_own") + left(F.col("_many")) * F.col("_first"), digits))).drop("_x", "_opens", "_first", "_own", "_many")
    cut, w = segmented(df, keys, by, cut_points(df, by, parts)), _local().orderBy(*order)
    done = _folded_rows(cut.withColumns({"_x": x, "_opens": opens(w), "_ends": F.lead(F.lit(1)).over(w).isNull()}), alpha)
    first = cut.select("_key", "_seg", F.struct(*order, F.when(~F.isnan(value), value).alias("_x")).alias("_r")).filter(F.col("_r._x").isNotNull()).groupBy("_key", "_seg").agg(F.min("_r")["_x"].alias("_first"))
    ends = done.filter("_ends").select("_key", "_seg", "_own", "_many").join(first, ["_key", "_seg"], "left")
    earlier = F.collect_list(F.struct("_own", "_many")).over(_across().rowsBetween(Window.unboundedPreceding, -1))
    opening = F.first("_first", ignorenulls=True).over(_across().rowsBetween(Window.unboundedPreceding, 0))
    state = ends.select("_key", "_seg", earlier.alias("_earlier"), opening.alias("_opening"))
    carried = state.select("_key", "_seg", F.aggregate("_earlier", F.col("_opening"), lambda s, e: e["_own"] + left(e["_many"]) * s).alias("_carried"), F.aggregate("_earlier", F.lit(0).cast("long"), lambda s, e: s + e["_many"]).alias("_before"))
    out = done.join(carried, ["_key", "_seg"])
    total = F.round(F.col("_own") + left(F.col("_many")) * F.col("_carried"), digits)
    return out.withColumn(name, F.when(F.col("_many") + F.col("_before") > 0, total)).drop("_key", "_seg", "_x", "_opens", "_ends", "_own", "_many", "_carried", "_before")


def quantiles(df: DataFrame, keys: Sequence[str], col: str, probabilities: Sequence[float], parts: int | None = None) -> DataFrame:
    """keys and ``q`` (array of double): exact quantiles with linear interpolation of each key's values, nulls left
    out; nulls for keys without values. Equal values are counted first and the counts written; ranks come
    from running counts, so no task holds a key's values."""
    counted = written(df.select(*keys, F.col(col).cast("double").alias("_x")).groupBy(*keys, "_x").agg(F.count("_x").alias("_n")), "values")
    ranked = running_sums(counted, keys, ["_x"], "_x", {"_upto": F.col("_n")}, parts)
    key = F.struct(*(F.col(k) for k in keys)) if keys else F.struct(F.lit(0).alias("_"))
    total = ranked.select(key.alias("_key"), "*").groupBy("_key").agg(F.max("_upto").alias("_total"))
    held = ranked.select(key.alias("_key"), *keys, "_x", "_n", "_upto").join(total, "_key")
    place = [F.lit(float(p)) * (F.col("_total") - 1) for p in probabilities]
    low, high = [F.floor(p).cast("long") for p in place], [F.ceil(p).cast("long") for p in place]
    of = lambda rank: F.max(F.when((F.col("_upto") > rank) & (F.col("_upto") - F.col("_n") <= rank), F.col("_x")))
    picked = held.groupBy("_key", *keys).agg(F.max("_total").alias("_total"), *(of(r).alias(f"_{k}_{i}") for k, rs in (("l", low), ("h", high)) for i, r in enumerate(rs)))
    q = F.array(*(F.col(f"_l_{i}") + (F.col(f"_h_{i}") - F.col(f"_l_{i}")) * (p - F.floor(p)) for i, p in enumerate(place)))
    return picked.select(*keys, q.alias("q"))


def dense_ids(df: DataFrame, order: Sequence[str | Column], name: str = "row_id", parts: int | None = None) -> DataFrame:
    """df with ids 1, 2, ... in a total order, none left out: rows are dealt by ranges of the order and written
    sorted with their place in the range; the ranges' counts (a row each) give each range its offset. Rows that
    the order doesn't tell apart are numbered in some order, once."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    placed = written(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", at), "ranges")
    counts = placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # of one row a range
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), F.shiftright("_at", 33) == F.col("_part")).withColumn(name, F.col("_offset") + place + 1).drop("_at", "_part", "_offset")
