"""The member-game relation over the test tables, in Spark and in SQL, and the query registry's parts.

Order lines play the game log: part = member, supplier = group, order = event. All measures are
integers, so that sums are exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.operators.windows import dedupe_latest
from gamelake.sources.tables import scratch, written  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

STATS = ("fg3a", "fg3m", "ast", "stl", "tov", "pts", "fga", "fgm", "fta", "ftm", "oreb", "dreb", "reb", "blk")


def query(sql: str | None = None):
    """Register a query under its function's name, with SQL for the same rows."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


MEASURES = {
    "fga": "CAST(l_quantity AS INT)",
    "disc": "CAST(round(l_discount * 100) AS INT)",
    "tax": "CAST(round(l_tax * 100) AS INT)",
    "cents": "CAST(round(l_extendedprice * 100) AS BIGINT)",
}
DERIVED = {
    "fgm": "CAST(floor(fga / 2.0) AS INT)",
    "fg3m": "fga % 5",
    "fg3a": "fga % 5 + disc",
    "fta": "tax",
    "ftm": "CAST(floor(tax / 2.0) AS INT)",
    "oreb": "disc",
    "dreb": "tax",
    "reb": "disc + tax",
    "ast": "line_no",
    "stl": "fga % 3",
    "blk": "fga % 2",
    "tov": "disc",
    "pts": "2 * CAST(floor(fga / 2.0) AS INT) + fga % 5 + CAST(floor(tax / 2.0) AS INT)",
    "plus_minus": "fga - 25",
}
IDS = {
    "member_id": "l_partkey",
    "group_id": "l_suppkey",
    "event_id": "l_orderkey",
    "line_no": "l_linenumber",
    "event_date": "CAST(o_orderdate AS DATE)",
    "season": "CAST(year(o_orderdate) AS INT)",
    "season_type": "o_orderpriority",
    "outcome": "l_returnflag",
    "status": "l_linestatus",
    "cust_id": "o_custkey",
}

_ROUNDED = "CASE WHEN abs({0} - rint({0})) = 0.5 THEN {0} + signum({0}) * 0.5 ELSE rint({0}) END"
#: The same values in Spark's terms where its own form goes through decimals, one object or more a row: ``round`` of a
#: double and division by 2.0. (A half is exact in a double, and so is the difference to the nearest whole number.)
NATIVE = {
    "disc": f"CAST({_ROUNDED.format('l_discount * 100')} AS INT)",
    "tax": f"CAST({_ROUNDED.format('l_tax * 100')} AS INT)",
    "cents": f"CAST({_ROUNDED.format('l_extendedprice * 100')} AS BIGINT)",
    "fgm": "shiftright(fga, 1)",
    "ftm": "shiftright(tax, 1)",
    "pts": "2 * shiftright(fga, 1) + fga % 5 + shiftright(tax, 1)",
}

RAW_SQL = f"""SELECT *, {', '.join(f'{e} AS {n}' for n, e in DERIVED.items())} FROM (
  SELECT {', '.join(f'{e} AS {n}' for n, e in (IDS | MEASURES).items())} FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
ORDER = ("line_no", "group_id", "fga", "cents", "disc", "tax", "outcome", "status")
BOX_SQL = f"""SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY member_id, season, event_id ORDER BY {', '.join(c + ' DESC' for c in ORDER)}) AS n FROM raw) WHERE n = 1"""
#: Start of a WITH list: raw has every line, box one row for each (member, season, event).
WITH = f"WITH raw AS ({RAW_SQL}), box AS ({BOX_SQL})"
GROUP_SQL = "SELECT group_id, season, season_type, event_id, event_date, " + ", ".join(f"CAST(sum({s}) AS BIGINT) AS {s}" for s in STATS) + ", min(outcome) AS outcome FROM box GROUP BY group_id, season, season_type, event_id, event_date"


def _columns(terms: dict[str, str]) -> list[Column]:
    return [F.expr(NATIVE.get(n, e)).alias(n) for n, e in terms.items()]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line with its order's columns; both sides are read with the needed columns only."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    both = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return both.select(*_columns(IDS | MEASURES)).select("*", *_columns(DERIVED))


def box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each member, season and event: the latest in a total order.

    An event has one season, so lines are deduplicated before the join with their orders; dealt by
    event, they need no other shuffle for the window, the join, or a grouping or window by event that
    follows. Derived columns are made of what is left."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    own = {n: e for n, e in (IDS | MEASURES).items() if "o_" not in e}
    named = lines.select("l_orderkey", *_columns({n: e for n, e in own.items() if n != "event_id"})).repartition("l_orderkey")
    latest = dedupe_latest(named, ["l_orderkey", "member_id"], [F.col(c).desc() for c in ORDER])
    both = latest.join(orders, latest["l_orderkey"] == orders["o_orderkey"])
    rows = both.select(*(F.col(n) if n in own and n != "event_id" else F.expr(e).alias(n) for n, e in (IDS | MEASURES).items()))
    return rows.select("*", *_columns(DERIVED))


def group_events(df: DataFrame, *more: Column) -> DataFrame:
    """Member rows summed to (group, season, event), with further aggregates."""
    keys = ("group_id", "season", "season_type", "event_id", "event_date")
    return df.groupBy(*keys).agg(*(F.sum(s).alias(s) for s in STATS), F.min("outcome").alias("outcome"), *more)
