"""The star schema: event, period, member and group dimensions, facts, advanced facts.

Each model is DataFrames in, DataFrame out, so that Catalyst sees the whole chain."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gamelake.functions import advanced
from gamelake.functions.scalars import home_away, readable_key, row_hash, surrogate_key
from gamelake.operators import aggregates, joins, scd, windows
from gamelake.sources.tables import written

OPEN_END = "9999-12-31"


def dim_event(df: DataFrame) -> DataFrame:
    """One row per event with its sides, from columns event_id, event_date, matchup, season, season_type."""
    home, away = home_away(F.col("matchup"))
    rows = aggregates.distinct_rows(df, ["event_id", "event_date", "matchup", "season", "season_type"])
    return rows.select(surrogate_key(["event_id"]).alias("event_key"), "*", home.alias("home"), away.alias("away"))


def dim_period(df: DataFrame, date: str = "event_date") -> DataFrame:
    """One row per season and season type, with its dates."""
    return aggregates.date_ranges(df, ["season", "season_type"], date).select(surrogate_key(["season", "season_type"]).alias("season_key"), "*")


def dim_scd2(df: DataFrame, key: str, date: str, attrs: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Versions of a member or group, one row per block of constant attributes. valid_to is the day
    before the next version, so that ranges don't overlap; versions that start and end on one day
    (a later one began the same day) keep their place but hold no date."""
    blocks = scd.scd2_from_events(df, [key], date, attrs, order)
    return blocks.withColumn("valid_to", F.coalesce(F.date_add("next_start", -1), F.lit(OPEN_END).cast("date")))


def fact_member(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Member rows with their natural key, hash and the range of the block of their group."""
    keyed = df.withColumns({"fact_key": readable_key(["member_id", "season", "event_id"]), "row_hash": row_hash(["member_id", "group_id", "event_id", *measures])})
    order = [F.col("event_date"), F.col("event_id")]
    marked = windows.block_id(windows.change_flag(keyed, ["member_id"], order, ["group_id"]), ["member_id"], order)
    w = windows.Window.partitionBy("member_id", "block")
    return marked.select("fact_key", "member_id", "group_id", "event_id", "event_date", "season", *measures, "row_hash", F.min("event_date").over(w).alias("block_start"), F.max("event_date").over(w).alias("block_end"))


def fact_group(groups: DataFrame, dim_group: DataFrame, dim_season: DataFrame) -> DataFrame:
    """Group rows, which have their event_key (join it while they lie by event), with the other foreign keys: the
    group's version at the date, the season."""
    f = joins.asof_join(groups, dim_group, "group_id", "event_date", "start_date", "valid_to", ["version_key"])
    s = dim_season.withColumnRenamed("season_type", "_type")
    f = joins.scd_join(f.withColumn("_type", F.col("season_type")), s, ["season", "_type"], "event_date", "start_date", "end_date", ["season_key"]).drop("_type")
    return f.select(*(c for c in f.columns if c != "event_key"), "event_key", readable_key(["group_id", "season", "event_id"]).alias("fact_key"))


def side_versions(events: DataFrame, dim: DataFrame, alternate: str, sides: Sequence[str] = ("home", "away")) -> DataFrame:
    """Events with the version that each side had at the date, found by an alternate key of the dimension
    (a name or abbreviation). A version is told by side and date, so the versions are found once for the
    different pairs of all sides, by one ordered pass, and each side joins them."""
    pairs = [events.select(F.col(side).alias("_side"), F.col("event_date").alias("_date")) for side in sides]
    at = written(reduce(DataFrame.union, pairs).distinct(), "pairs")
    held, out = written(joins.asof_join(at, dim, "_side", "_date", "start_date", "valid_to", ["version_key"], alternate), "held"), events
    for side in sides:
        own = held.select(F.col("_side").alias(f"_{side}"), F.col("_date"), F.col("version_key").alias(f"{side}_version_key"))
        out = out.join(own, (out[side] == own[f"_{side}"]) & (out["event_date"] == own["_date"]), "left").drop(f"_{side}", "_date")
    return out


def member_advanced(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Shooting, usage and shares of the group's totals for every member row; one projection."""
    keys = ["group_id", "season", "event_id", "season_type"]
    j = joins.join_member_group(members, groups.select(*keys, *advanced.SHARES), keys)
    c, g = F.col, lambda s: F.col(f"g_{s}")
    return j.select(
        "member_id", *keys,
        advanced.true_shooting(c("pts"), c("fga"), c("fta")).alias("true_shooting"),
        advanced.effective_fg(c("fgm"), c("fg3m"), c("fga")).alias("effective_fg"),
        advanced.usage(c("fga"), c("fta"), c("tov"), g("fga"), g("fta"), g("tov")).alias("usage_pct"),
        *advanced.shares("", "g_", "share"),
    )


def group_advanced(groups: DataFrame, prefix: str = "opp_") -> DataFrame:
    """Shooting, rates and shares of the event's totals for every group row with each opponent: an event of k
    sides has k (k - 1) rows, two for the usual two. What tells of the group alone is computed once a row,
    before the join. A missing opponent has id -1 and statistics of 0."""
    keys, c = ["season", "event_id", "season_type"], F.col
    own = [advanced.true_shooting(c("pts"), c("fga"), c("fta")).alias("true_shooting"), advanced.effective_fg(c("fgm"), c("fg3m"), c("fga")).alias("effective_fg"), *advanced.group_rates()]
    whole = all(t in ("int", "bigint") for n, t in groups.dtypes if n in advanced.SHARES)
    rated = groups.select("group_id", *keys, *advanced.SHARES, *own)
    j = joins.opponent_join(rated, keys, "group_id", advanced.SHARES, prefix)
    ready = ["true_shooting", "effective_fg", "three_point_rate", "turnover_pct", "offensive_rating", "free_throw_rate"]
    return j.select("group_id", *keys, F.coalesce(c(f"{prefix}group_id"), F.lit(-1)).alias("opponent_id"), *ready, *advanced.game_shares("", prefix, "game_share", whole=whole))


def split_star(df: DataFrame, dims: dict[str, Sequence[str]], fact: Sequence[str]) -> dict[str, DataFrame]:
    """Distinct dimension tables (the first column of each is its key) and the fact table of a batch.

    In a stream, call it in foreachBatch and merge the dimensions with ``scd.scd2_merge``."""
    out = {name: df.select(*cols).filter(F.col(cols[0]).isNotNull()).distinct() for name, cols in dims.items()}
    return out | {"fact": df.select(*fact)}
