"""Data-quality checks: all checks on a table run as one aggregate and give rows (check, column, failed, total)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.operators.aggregates import bin_of


@dataclass(frozen=True)
class Check:
    name: str
    column: str
    fails: Column


def not_null(col: str) -> Check:
    return Check("not_null", col, F.col(col).isNull())


def in_range(col: str, low: float | None, high: float | None) -> Check:
    """Nulls pass; they are another check's matter."""
    c = F.col(col)
    bad = F.lit(False)
    if low is not None:
        bad = bad | (c < low)
    if high is not None:
        bad = bad | (c > high)
    return Check("range", col, F.coalesce(bad, F.lit(False)))


def not_negative(col: str) -> Check:
    return Check("not_negative", col, F.coalesce(F.col(col) < 0, F.lit(False)))


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(c.name).alias("check"), F.lit(c.column).alias("column"), F.count_if(c.fails).alias("failed"), F.count("*").alias("total")) for c in checks))
    return df.agg(rows.alias("_r")).select(F.inline("_r"))


def unique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """How many of the keys occur more than once."""
    groups = df.groupBy(*cols).agg(F.count("*").alias("_n"))
    return groups.agg(F.count_if(F.col("_n") > 1).alias("failed"), F.coalesce(F.sum("_n"), F.lit(0)).alias("total")).select(F.lit("unique").alias("check"), F.lit("+".join(cols)).alias("column"), "failed", "total")


def report(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def alert_below(metrics: DataFrame, value: str, threshold: float) -> DataFrame:
    """Metric rows with is_alert where the value is below the threshold or missing."""
    return metrics.withColumn("is_alert", F.coalesce(F.col(value) < threshold, F.lit(True)))


def drift(a: DataFrame, b: DataFrame, col: str, low: float, high: float, bins: int, digits: int = 6) -> DataFrame:
    """Population stability index of a column between two tables; empty bins count as half a row."""
    both = a.select(F.col(col), F.lit(True).alias("_in_a")).union(b.select(F.col(col), F.lit(False).alias("_in_a")))
    return drift_within(both, F.col("_in_a"), col, low, high, bins, digits)


def drift_within(df: DataFrame, in_a: Column, col: str, low: float, high: float, bins: int, digits: int = 6) -> DataFrame:
    """The same between the rows of one table that meet a condition and those that don't; it is read once."""
    n = df.groupBy(bin_of(F.col(col), low, high, bins).alias("bin")).agg(F.greatest(F.count_if(in_a).cast("double"), F.lit(0.5)).alias("x"), F.greatest(F.count_if(~in_a).cast("double"), F.lit(0.5)).alias("y"))
    # sum (x - y) ln(x / y) over shares, written with sums over the bins, so that one aggregate gives it:
    # the logarithm of the totals' ratio cancels, as both shares sum to one
    x, y, ln = F.col("x"), F.col("y"), F.log(F.col("x") / F.col("y"))
    sums = n.agg(F.sum("x").alias("sx"), F.sum("y").alias("sy"), F.sum(x * ln).alias("xl"), F.sum(y * ln).alias("yl"))
    psi = F.col("xl") / F.col("sx") - F.col("yl") / F.col("sy")
    return sums.select(F.lit(col).alias("column"), F.round(psi, digits).alias("psi"))
