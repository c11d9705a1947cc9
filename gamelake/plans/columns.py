"""Queries on columns and rows: filling, cleaning, flattening, ids, optional joins, wider batches."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.operators import aggregates, joins, project, scans, scd
from gamelake.plans.base import STATS, WITH, box, query, table, written
from gamelake.sources import documents
from gamelake.streaming import streams

S = SparkSession


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE o_custkey END AS cust, CASE WHEN o_orderstatus = 'O' THEN 0.0 ELSE o_totalprice END AS price,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS priority FROM orders"""
)
def filled_numbers(spark: S, sf: str) -> DataFrame:
    """Nulls as 0 in numbers; texts stay null."""
    o, status = table(spark, sf, "orders"), F.col("o_orderstatus")
    holes = o.select("o_orderkey", F.when(status != "F", F.col("o_custkey")).alias("cust"), F.when(status != "O", F.col("o_totalprice")).alias("price"), F.when(status != "P", F.col("o_orderpriority")).alias("priority"))
    return project.fill_numeric(holes)


@query(
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS price, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_custkey END AS cust FROM orders"""
)
def cleaned_doubles(spark: S, sf: str) -> DataFrame:
    """NaN (status F), infinite (P) and null values as 0 in doubles; other types stay."""
    o, status = table(spark, sf, "orders"), F.col("o_orderstatus")
    odd = F.when(status == "F", F.lit(float("nan"))).when(status == "P", F.lit(float("-inf"))).otherwise(F.col("o_totalprice"))
    return project.clean_doubles(o.select("o_orderkey", odd.alias("price"), F.when(status != "P", F.col("o_custkey")).alias("cust")))


@query("SELECT o_custkey AS cust, o_orderpriority AS priority FROM orders WHERE o_orderstatus <> 'P'")
def rows_with_values(spark: S, sf: str) -> DataFrame:
    """Rows that are null in every column are dropped."""
    o, kept = table(spark, sf, "orders"), F.col("o_orderstatus") != "P"
    return documents.drop_all_null(o.select(F.when(kept, F.col("o_custkey")).alias("cust"), F.when(kept, F.col("o_orderpriority")).alias("priority")))


@query("SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_key, l_suppkey AS part_supplier FROM lineitem")
def exploded_lines(spark: S, sf: str) -> DataFrame:
    """Orders with an array of nested structs: one row for each element, with the parent's key."""
    part = F.struct(F.col("l_partkey").alias("key"), F.col("l_suppkey").alias("supplier"))
    nested = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(F.collect_list(F.struct(F.col("l_linenumber").alias("line"), part.alias("part"))).alias("lines"))
    return documents.explode_path(nested, "lines", ["order_id"])


@query("SELECT o_orderkey AS order_key, o_custkey AS order_customer_key, o_orderstatus AS status FROM orders")
def names_without_dots(spark: S, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return project.dots_to_underscores(o.select(F.col("o_orderkey").alias("order.key"), F.col("o_custkey").alias("order.customer.key"), F.col("o_orderstatus").alias("status")))


@query("SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber) AS row_id FROM lineitem")
def row_ids(spark: S, sf: str) -> DataFrame:
    """Dense ids in the order of the key."""
    return scans.dense_ids(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT count(*) AS n_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS n_ids FROM lineitem")
def row_hashes(spark: S, sf: str) -> DataFrame:
    """Ids from the key's hash, which need no order: as many as the keys here."""
    ids = project.row_id(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])
    return ids.agg(F.count("*").alias("n_rows"), F.countDistinct("row_id").alias("n_ids"))


@query("SELECT o_custkey AS id, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY o_custkey")
def current_versions(spark: S, sf: str) -> DataFrame:
    """The current row of every customer's history of statuses."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("at"), "o_orderkey")
    return project.current_rows(scd.scd2_from_events(o, ["id"], "at", ["status"], ["o_orderkey"])).select("id", "status")


@query(f"{WITH} SELECT group_id, event_id, {', '.join(f'CAST(sum({s}) AS BIGINT) AS {s}' for s in STATS)}, min(outcome) AS outcome, min(season_type) AS season_type FROM box GROUP BY group_id, event_id")
def side_rollup(spark: S, sf: str) -> DataFrame:
    """Fourteen sums and the smallest attributes of a group in an event."""
    return aggregates.rollup_to_group(box(spark, sf), ["group_id", "event_id"], STATS, ["outcome", "season_type"])


@query("SELECT s_suppkey, s_nationkey, n_name, CAST(NULL AS VARCHAR) AS absent FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey")
def optional_joins(spark: S, sf: str) -> DataFrame:
    """A dimension that the catalog has, and one that it lacks."""
    base = f"dims_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {base}")
    try:
        n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        n.write.saveAsTable(f"{base}.nation")
        s = table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
        both = joins.maybe_join(spark, joins.maybe_join(spark, s, f"{base}.nation", "s_nationkey"), f"{base}.region", "s_nationkey")
        return written(both.withColumn("absent", F.lit(None).cast("string")), "optional")
    finally:
        spark.sql(f"DROP DATABASE {base} CASCADE")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM orders b WHERE b.o_totalprice > 300000 AND b.o_custkey = o.o_custkey AND b.o_orderpriority = o.o_orderpriority)")
def rows_without_match(spark: S, sf: str) -> DataFrame:
    """Orders whose customer has no large order of their priority."""
    o = table(spark, sf, "orders")
    large = o.filter("o_totalprice > 300000").select("o_custkey", "o_orderpriority").distinct()
    return joins.missing_keys(o, large, ["o_custkey", "o_orderpriority"]).select("o_orderkey")


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS clicked_by, CASE WHEN event_type <> 'click' THEN CAST(user_id AS VARCHAR) END AS seen_by, CAST(NULL AS VARCHAR) AS base FROM events")
def widened_batch(spark: S, sf: str) -> DataFrame:
    """JSON objects with differing keys, widened to all keys of the batch beside those of the schema."""
    e, click = table(spark, sf, "events"), F.col("event_type") == "click"
    who = F.col("user_id").cast("string")
    value = F.to_json(F.struct(F.col("event_id").cast("string").alias("event_id"), F.when(click, who).alias("clicked_by"), F.when(~click, who).alias("seen_by")))
    return streams.widen_batch(e.select(value.alias("value")), ["base"])
