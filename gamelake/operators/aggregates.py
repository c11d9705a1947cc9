"""Groupings: rollups, facts, cumulative tables, leaders, distributions. Each is one map-side combined aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions.scalars import count_reaching, safe_ratio
from gamelake.operators import scans
from gamelake.operators.project import latest_season


def rollup_to_group(df: DataFrame, keys: Sequence[str], sums: Sequence[str], firsts: Sequence[str] = ()) -> DataFrame:
    """Member rows summed to their group; attributes are represented by their smallest value."""
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums), *(F.min(c).alias(c) for c in firsts))


def distinct_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()


def pick_and_count(df: DataFrame, key: str, variants: Sequence[str], count: str = "pairs") -> DataFrame:
    """One row per key: how many different variants it has, and the smallest of them."""
    v = F.struct(*variants)
    return df.select(key, v.alias("_v")).distinct().groupBy(key).agg(F.count("*").alias(count), F.min("_v").alias("_v")).select(key, count, "_v.*")


def date_ranges(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(date).alias("start_date"), F.max(date).alias("end_date"))


def is_active(df: DataFrame, key: str, date: str) -> DataFrame:
    """Whether the key's last date is the table's last date. The second aggregate runs over the first."""
    last = df.groupBy(key).agg(F.max(date).alias("last_date"))
    return last.withColumn("is_active", F.coalesce(F.col("last_date") == last.agg(F.max("last_date")).scalar(), F.lit(False)))


def bucketed_fact(df: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), avgs: Sequence[str] = (), bucket: Column | None = None, bucket_name: str = "bucket") -> DataFrame:
    """Sums as long and averages per key, and per bucket if there is one."""
    if bucket is not None:
        df, keys = df.withColumn(bucket_name, bucket), [*keys, bucket_name]
    return df.groupBy(*keys).agg(*(F.sum(c).cast("long").alias(f"total_{c}") for c in sums), *(F.avg(c).alias(f"avg_{c}") for c in avgs))


def sum_and_avg_fact(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return bucketed_fact(df, keys, measures, measures)


def cumulative(df: DataFrame, entity: Sequence[str], measures: Sequence[str], scope: str = "all", kind: str = "totals", season: str = "season", current: str | None = None) -> DataFrame:
    """Totals or averages per entity over the latest season ("current") or over all; rows that are not
    current versions are left out where the table has such a flag."""
    if current:
        df = df.filter(F.col(current))
    keys = list(entity)
    if scope == "current":
        df, keys = latest_season(df, season), [*keys, season]
    fn = F.sum if kind == "totals" else F.avg
    return df.groupBy(*keys).agg(*(fn(c).alias(f"{'total' if kind == 'totals' else 'avg'}_{c}") for c in measures))


def multi_threshold_count(df: DataFrame, keys: Sequence[str], cols: Sequence[str], threshold: float = 10) -> DataFrame:
    """Rows with at least two, and at least three, of the columns at the threshold."""
    n = count_reaching([F.col(c) for c in cols], threshold)
    return df.groupBy(*keys).agg(F.count_if(n >= 2).alias("double_doubles"), F.count_if(n >= 3).alias("triple_doubles"))


def outcome_pivot(df: DataFrame, keys: Sequence[str], outcome: str, measure: str, win: str, loss: str) -> DataFrame:
    """Totals, counts and averages of the measure in wins and in losses."""
    w, x = F.col(outcome) == win, F.col(outcome) == loss
    m = F.col(measure)
    return df.groupBy(*keys).agg(
        F.sum(F.when(w, m).otherwise(0)).alias(f"{measure}_in_wins"),
        F.sum(F.when(x, m).otherwise(0)).alias(f"{measure}_in_losses"),
        F.count_if(w).alias("wins"),
        F.count_if(x).alias("losses"),
        F.round(F.avg(F.when(w, m)), 3).alias(f"avg_{measure}_in_wins"),
        F.round(F.avg(F.when(x, m)), 3).alias(f"avg_{measure}_in_losses"),
    )


def summary(df: DataFrame, keys: Sequence[str], event: str, measures: Sequence[str], digits: int = 2, unique: bool = False) -> DataFrame:
    """Number of different events and rounded averages. ``unique``: no key has two rows of an event, so that its events
    are counted without a group, and a shuffled row, for each."""
    many = F.count if unique else F.count_distinct
    return df.groupBy(*keys).agg(many(event).alias("events"), *(F.round(F.avg(c), digits).alias(f"avg_{c}") for c in measures))


def leaders(df: DataFrame, by: Sequence[str], metric: Column, name: str, k: int, order: Sequence[str] | None = None) -> DataFrame:
    """The k groups with the highest metric; ties by the group's key. A top-k without a global sort."""
    return df.groupBy(*by).agg(metric.alias(name)).orderBy(F.col(name).desc(), *(order or by)).limit(k)


def ratio_leaders(df: DataFrame, by: Sequence[str], n: str, d: str, least: float, k: int, digits: int = 3) -> DataFrame:
    """Groups whose total of ``d`` reaches ``least``, by the ratio of the totals."""
    g = df.groupBy(*by).agg(F.sum(n).alias(f"total_{n}"), F.sum(d).alias(f"total_{d}")).filter(F.col(f"total_{d}") >= least)
    return g.withColumn("ratio", safe_ratio(F.col(f"total_{n}"), F.col(f"total_{d}"), digits)).orderBy(F.col("ratio").desc(), *by).limit(k)


def combined_leaders(df: DataFrame, by: Sequence[str], a: str, b: str, k: int) -> DataFrame:
    """Groups by the sum of two totals."""
    g = df.groupBy(*by).agg(F.sum(a).alias(f"total_{a}"), F.sum(b).alias(f"total_{b}"))
    return g.withColumn("combined", F.col(f"total_{a}") + F.col(f"total_{b}")).orderBy(F.col("combined").desc(), *by).limit(k)


def split_ratios(df: DataFrame, keys: Sequence[str], pairs: Mapping[str, tuple[str, str]], digits: int = 3) -> DataFrame:
    """Ratio of two totals for each named pair; null where the second is zero."""
    return df.groupBy(*keys).agg(*(safe_ratio(F.sum(a), F.sum(b), digits).alias(name) for name, (a, b) in pairs.items()))


def threshold_counts(df: DataFrame, keys: Sequence[str], measure: str, thresholds: Sequence[int]) -> DataFrame:
    return df.groupBy(*keys).agg(*(F.count_if(F.col(measure) >= t).alias(f"{measure}_{t}_plus") for t in thresholds))


#: Functions of the metric catalogue.
METRICS = {"avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max, "count": F.count, "count_distinct": F.count_distinct}


def metrics(df: DataFrame, by: Sequence[str], names: Sequence[str], order: str | None = None, limit: int | None = None) -> DataFrame:
    """Any of the catalogue's metrics, named function__column, for any grouping."""
    cols = [METRICS[f](c).alias(n) for n in names for f, _, c in (n.partition("__"),)]
    out = df.groupBy(*by).agg(*cols)
    if order:
        out = out.orderBy(F.col(order).desc(), *by)
    return out.limit(limit) if limit else out


def trend(df: DataFrame, date: str, grain: str, names: Sequence[str], dims: Sequence[str] = ()) -> DataFrame:
    """Metrics by day, month or year."""
    return metrics(df.withColumn("period", F.to_date(F.date_trunc(grain, date))), ["period", *dims], names)


def bin_of(c: Column, low: float, high: float, bins: int) -> Column:
    """Bin number from 1; 0 below low and bins + 1 from high on."""
    return F.width_bucket(c.cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(bins)).cast("int")


def histogram(df: DataFrame, col: str, low: float, high: float, bins: int) -> DataFrame:
    return df.groupBy(bin_of(F.col(col), low, high, bins).alias("bin")).agg(F.count("*").alias("n"))


def heatmap(df: DataFrame, x: str, y: str, xs: tuple[float, float, int], ys: tuple[float, float, int], by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by, bin_of(F.col(x), *xs).alias("x_bin"), bin_of(F.col(y), *ys).alias("y_bin")).agg(F.count("*").alias("n"))


def box_stats(df: DataFrame, by: Sequence[str], col: str) -> DataFrame:
    """Five-number summary, with interpolated quartiles, exact in bounded memory (``scans.quantiles``). Groups
    without a value have nulls."""
    names = ("low", "q1", "median", "q3", "high")
    return scans.quantiles(df, by, col, (0.0, 0.25, 0.5, 0.75, 1.0)).select(*by, *(F.col("q")[i].alias(n) for i, n in enumerate(names)))


def correlations(df: DataFrame, by: Sequence[str], pairs: Sequence[tuple[str, str]], digits: int = 6) -> DataFrame:
    return df.groupBy(*by).agg(*(F.round(F.corr(a, b), digits).alias(f"corr_{a}_{b}") for a, b in pairs))


def share_of_total(df: DataFrame, by: Sequence[str], measure: str, digits: int = 6) -> DataFrame:
    """Each group's share of the whole; the total is taken over the groups, not the rows."""
    g = df.groupBy(*by).agg(F.sum(measure).alias("total"))
    return g.withColumn("share", F.round(F.col("total").cast("double") / g.agg(F.sum("total")).scalar(), digits))


def kpi(df: DataFrame, measure: str, digits: int = 4) -> DataFrame:
    return df.agg(F.count("*").alias("n"), F.round(F.avg(measure), digits).alias("average"), F.max(measure).alias("highest"))


def collect_series(df: DataFrame, key: str, order: Sequence[str], value: str, length: int = 10_000) -> DataFrame:
    """Each entity's values in order, as arrays of at most ``length`` values: key, piece (from 0), series."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    cut = df.select(key, place.alias("_place"), F.col(value).alias("_value")).withColumn("piece", F.floor(F.col("_place") / length).cast("int"))
    series = F.sort_array(F.collect_list(F.struct("_place", "_value")))
    return cut.groupBy(key, "piece").agg(F.transform(series, lambda s: s["_value"]).alias("series"))


def profile_groups(df: DataFrame, by: str, cols: Sequence[str], digits: int = 4) -> DataFrame:
    """Mean and sample standard deviation of every column in every group."""
    return df.groupBy(by).agg(*(fn(c) for c in cols for fn in (lambda c: F.round(F.avg(c), digits).alias(f"{c}_mean"), lambda c: F.round(F.stddev(c), digits).alias(f"{c}_stddev"))))


def approx_quantiles(df: DataFrame, by: Sequence[str], col: str, probabilities: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    return df.groupBy(*by).agg(F.percentile_approx(col, list(probabilities), accuracy).alias("quantiles"))


def profile(df: DataFrame, digits: int = 4) -> DataFrame:
    """One row per column: type, nulls, and count, mean, smallest and largest of numbers; one pass."""
    numbers = {c for c, t in df.dtypes if t in ("int", "bigint", "double", "float", "smallint", "tinyint") or t.startswith("decimal")}
    kinds = dict(df.dtypes)
    stats = [
        F.struct(
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count(c).alias("n"),
            (F.round(F.avg(c), digits) if c in numbers else F.lit(None)).cast("double").alias("mean"),
            (F.min(c) if c in numbers else F.lit(None)).cast("double").alias("low"), (F.max(c) if c in numbers else F.lit(None)).cast("double").alias("high"),
        )
        for c in df.columns
    ]
    return df.agg(F.array(*stats).alias("_s")).select(F.inline("_s"))


def event_facts(df: DataFrame, keys: Sequence[str], sums: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Sums, averages and whether a flag held in any row."""
    return df.groupBy(*keys).agg(*(F.sum(c).alias(f"total_{c}") for c in sums), *(F.avg(c).alias(f"avg_{c}") for c in sums), *(F.bool_or(c).alias(n) for n, c in flags.items()))


def share_window(df: DataFrame, by: Sequence[str], measure: str) -> Column:
    """A row's share of its group's total, as a window expression."""
    return F.col(measure).cast("double") / F.sum(measure).over(Window.partitionBy(*by))
