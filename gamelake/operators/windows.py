"""Window operators. Every order is made total with tie-breakers, so results don't depend on partitioning.

All windows are partitioned by an entity; a top-n filter on a rank is pushed into the partial
"window group limit", so a large entity sends n rows a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


def _window(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order (pass descending columns for the latest)."""
    return df.withColumn("_n", F.row_number().over(_window(keys, order))).filter("_n = 1").drop("_n")


def change_flag(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], attrs: Sequence[str], name: str = "changed") -> DataFrame:
    """1 where an attribute differs (nulls compare as values) from the previous row, and on first rows."""
    w = _window(keys, order)
    same = F.lit(True)
    for a in attrs:
        same = same & F.col(a).eqNullSafe(F.lag(a).over(w))
    return df.withColumn(name, F.when((F.row_number().over(w) > 1) & same, 0).otherwise(1))


def block_id(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], flag: str = "changed", name: str = "block") -> DataFrame:
    """Running number of changes: one number per block of equal attributes."""
    return df.withColumn(name, F.sum(flag).over(_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)))


def block_ranges(df: DataFrame, keys: Sequence[str], date: str, attrs: Sequence[str], block: str = "block") -> DataFrame:
    """One row per block, with its first and last date."""
    return df.groupBy(*keys, block, *attrs).agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"))


def next_start(df: DataFrame, keys: Sequence[str], order: str, name: str = "next_start") -> DataFrame:
    return df.withColumn(name, F.lead(order).over(_window(keys, [order])))


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], n: int, ties: bool = True) -> DataFrame:
    """Rows ranked up to n in each group; ties share a rank and are all kept."""
    fn = F.rank() if ties else F.row_number()
    return df.withColumn("rank", fn.over(_window(keys, order))).filter(F.col("rank") <= n)


def rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], cols: Sequence[str], n: int, stats: Sequence[str] = ("avg",), digits: int | None = 4, fill: float | None = None) -> DataFrame:
    """Statistics over the last n rows, all in one window."""
    w = _window(keys, order).rowsBetween(-(n - 1), 0)
    fns = {"avg": F.avg, "stddev": F.stddev, "sum": F.sum, "min": F.min, "max": F.max}
    new = {}
    for c in cols:
        for s in stats:
            x = fns[s](c).over(w)
            x = F.coalesce(x.cast("double"), F.lit(fill)) if fill is not None else x
            new[f"{c}_{s}{n}"] = F.round(x, digits) if digits is not None else x
    return df.withColumns(new)


def lag_features(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], cols: Sequence[str], lags: int = 6) -> DataFrame:
    """Lags 1 to ``lags`` and the differences to them."""
    w = _window(keys, order)
    return df.withColumns({f"{c}_{kind}{i}": x for c in cols for i in range(1, lags + 1) for kind, x in (("lag", F.lag(c, i).over(w)), ("diff", F.col(c) - F.lag(c, i).over(w)))})


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], cols: Sequence[str]) -> DataFrame:
    w = _window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns({f"{c}_running": F.sum(c).over(w) for c in cols})


def longest_streaks(df: DataFrame, entity: Sequence[str], order: Sequence[str | Column], hit: Column) -> DataFrame:
    """Length of each entity's longest run of hits (0 if none): rows between breaks share the number of breaks before."""
    w = _window(entity, order).rowsBetween(Window.unboundedPreceding, 0)
    ok = F.coalesce(hit, F.lit(False))
    marked = df.select(*entity, ok.cast("int").alias("_hit"), F.sum((~ok).cast("int")).over(w).alias("_breaks"))
    return marked.groupBy(*entity, "_breaks").agg(F.sum("_hit").alias("_run")).groupBy(*entity).agg(F.max("_run").alias("longest_streak"))


def trailing_array(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], col: str, n: int = 7) -> DataFrame:
    """The last n values, oldest first."""
    return df.withColumn(f"{col}_last{n}", F.collect_list(col).over(_window(keys, order).rowsBetween(-(n - 1), 0)))


def ema(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], col: str, span: int = 3, memory: int | None = None, digits: int = 6) -> DataFrame:
    """Exponential moving average, s = a x + (1 - a) s' with a = 2 / (span + 1), from the first value on.

    It runs over the last ``memory`` values, whose weights sum to one within (1 - a)**memory, so that a
    row costs the same however long its entity's history is. By default as many as bring that below
    1e-19, 64 at least: some 22 times the span."""
    a = 2.0 / (span + 1)
    memory = memory or max(64, ceil(log(1e-19) / log(1 - a)) if a < 1 else 1)
    values = F.collect_list(F.col(col).cast("double")).over(_window(keys, order).rowsBetween(-(memory - 1), 0))
    s = F.aggregate(F.slice(values, 2, memory), F.element_at(values, 1), lambda s, x: F.lit(1 - a) * s + F.lit(a) * x)
    return df.withColumn(f"{col}_ema{span}", F.round(s, digits))


def time_holdout(df: DataFrame, date: str, ratio: float = 0.1) -> DataFrame:
    """is_holdout for the most recent share of rows: those after the first day by which at least 1 - ratio of the
    rows have come. Rows are counted by day and only days are ordered, so the cut is exact without a sort
    of rows. df is read twice."""
    day = F.unix_date(F.to_date(date))
    days = df.groupBy(day.alias("_d")).agg(F.count("*").alias("_n")).filter(F.col("_d").isNotNull())
    upto = F.sum("_n").over(Window.orderBy("_d"))  # a row for each day
    total = F.sum("_n").over(Window.partitionBy())
    cut = days.withColumns({"_upto": upto, "_all": total}).filter(F.col("_upto") >= F.ceil(F.lit(1.0 - ratio) * F.col("_all"))).agg(F.min("_d"))
    return df.withColumn("is_holdout", day > cut.scalar())


def time_folds(df: DataFrame, date: str, folds: int = 3, name: str = "fold", accuracy: int = 10_000) -> DataFrame:
    """fold: 0 for the earliest rows to folds - 1 for the latest, of about equal size; a day is in one fold.
    The cut-offs are approximate quantiles of one aggregate."""
    day = F.unix_date(F.to_date(date))
    cuts = df.agg(F.percentile_approx(day, [(k + 1) / folds for k in range(folds - 1)], accuracy)).scalar()
    return df.withColumn(name, sum(((day > cuts[k]).cast("int") for k in range(folds - 1)), F.lit(0)))


def adjust_pvalues(df: DataFrame, group: Sequence[str], p: str, tie: str) -> DataFrame:
    """Bonferroni and Benjamini-Hochberg corrections within each group."""
    m = F.count(p).over(Window.partitionBy(*group))
    down = _window(group, [F.col(p).desc(), F.col(tie).desc()])
    rank = F.row_number().over(_window(group, [F.col(p), F.col(tie)]))
    ranked = df.withColumns({"_m": m, "_rank": rank})
    bh = F.min(F.col(p) * F.col("_m") / F.col("_rank")).over(down.rowsBetween(Window.unboundedPreceding, 0))
    return ranked.withColumns({"p_bonferroni": F.least(F.lit(1.0), F.col(p) * F.col("_m")), "p_bh": F.least(F.lit(1.0), bh)}).drop("_m", "_rank")
