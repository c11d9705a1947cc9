"""Connected components by alternating star contractions (Kiveris et al. 2014), in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.llm.common import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node of its component) for each node of the edges (a, b).

    Each round writes the edges to the shared folder. Only one count and one checksum reach the
    driver. A node with many edges costs its minimum one row a task; the join that follows is skewed
    on one side only. Self loops and null ends are left out; no edges give no rows."""
    now = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    now = materialise(now, "edges")
    before = _state(now)
    while before[0]:
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a < b").distinct()
        up = large.select(F.col("b").alias("u"), F.col("a").alias("v"))
        low = up.groupBy("u").agg(F.min("v").alias("m"))
        small = up.join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).union(low.select(F.col("m").alias("a"), F.col("u").alias("b")))
        now = materialise(small.filter("a < b").distinct(), "edges")
        after = _state(now)
        if after == before:
            break
        before = after
    leaves = now.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    return leaves.union(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct().join(leaves.select("node"), "node", "left_anti"))
