"""Unions, unpivots and distinct rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_sides(sides: Mapping[str, DataFrame], tag: str = "side") -> DataFrame:
    """UNION ALL of tables with the same columns, each tagged with its name."""
    return reduce(lambda a, b: a.unionByName(b), (df.withColumn(tag, F.lit(name)) for name, df in sides.items()))


def union_missing(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def unpivot_sides(df: DataFrame, ids: Sequence[str], fields: Sequence[str], sides: Sequence[str] = ("home", "away"), tag: str = "side") -> DataFrame:
    """Wide <side>_<field> columns as one row per side; the table is read once."""
    rows = F.array(*(F.struct(F.lit(s).alias(tag), *(F.col(f"{s}_{f}").alias(f) for f in fields)) for s in sides))
    return df.select(*ids, F.inline(rows))


def distinct_by(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(keys)) if keys else df.distinct()
