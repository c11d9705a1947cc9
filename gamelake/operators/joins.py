"""Joins. Interval joins are equi-joins on the key with the range as a residual condition (``scd_join``), or,
for versions that don't overlap, one ordered pass over a key's facts and versions (``asof_join``); none is
key-less."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gamelake.operators import scans


def join_member_group(members: DataFrame, groups: DataFrame, keys: Sequence[str], prefix: str = "g_") -> DataFrame:
    """Each member row with its group's row; the group's other columns get the prefix."""
    other = groups.select(*keys, *(F.col(c).alias(f"{prefix}{c}") for c in groups.columns if c not in keys))
    return members.join(other, list(keys), "left")


def attach_sides(events: DataFrame, sides: DataFrame, event: str, name: str, home: str = "home", away: str = "away", cols: Sequence[str] = ()) -> DataFrame:
    """One table of (event, side name, columns) joined twice: as the home side and as the away side."""
    out = events
    for role in (home, away):
        s = sides.select(F.col(event).alias("_e"), F.col(name).alias("_n"), *(F.col(c).alias(f"{role}_{c}") for c in cols))
        out = out.join(s, (out[event] == s["_e"]) & (out[role] == s["_n"]), "left").drop("_e", "_n")
    return out


def opponent_join(df: DataFrame, keys: Sequence[str], ident: str, cols: Sequence[str], prefix: str = "opp_") -> DataFrame:
    """Each row with every other row of the same keys (and another ident), or with nulls if there is none. df is
    read once: a key's rows are listed where they lie together, which takes no shuffle where df lies by one of
    the keys, and each row meets the list (of k rows that give k (k - 1)). A join's and the shares' code in one
    method would be longer than the JVM compiles. Rows with a null key have no opponent."""
    there = F.lit(True)
    for k in keys:
        there = there & F.col(k).isNotNull()
    other = F.struct(F.col(ident).alias(f"{prefix}{ident}"), *(F.col(c).alias(f"{prefix}{c}") for c in cols))
    sides = F.collect_list(F.when(there, other)).over(Window.partitionBy(*keys))
    met = df.withColumn("_sides", sides).withColumn("_sides", F.filter("_sides", lambda s: s[f"{prefix}{ident}"] != F.col(ident)))
    return met.select(*df.columns, F.inline_outer("_sides"))


def scd_join(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], date: str, start: str, end: str, cols: Sequence[str], dim_key: str | Sequence[str] | None = None, prefix: str = "") -> DataFrame:
    """Left join to the dimension row of the key whose closed range holds the fact's date."""
    keys = [key] if isinstance(key, str) else list(key)
    theirs = keys if dim_key is None else [dim_key] if isinstance(dim_key, str) else list(dim_key)
    d = dim.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(theirs)), F.col(start).alias("_from"), F.col(end).alias("_to"), *(F.col(c).alias(f"{prefix}{c}") for c in cols))
    cond = fact[date].between(F.col("_from"), F.col("_to"))
    for i, k in enumerate(keys):
        cond = cond & (fact[k] == d[f"_k{i}"])
    return fact.join(d, cond, "left").drop("_from", "_to", *(f"_k{i}" for i in range(len(keys))))


def asof_join(fact: DataFrame, dim: DataFrame, key: str | Sequence[str], date: str, start: str, end: str, cols: Sequence[str], dim_key: str | Sequence[str] | None = None, prefix: str = "", parts: int | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """As ``scd_join`` for a dimension whose ranges of a key don't overlap (versions): facts and versions of a
    key in one order of dates, in which each fact takes the last version before it. The work grows with
    facts plus versions, whatever the history of a key, and a large key's rows are spread over segments of
    dates (``scans``), so that a few keys can hold all facts. Ranges that end before they start hold no date. Facts
    with a null key or date match nothing and pass by. Without ``cuts`` fact is read once more for them."""
    keys = [key] if isinstance(key, str) else list(key)
    theirs = keys if dim_key is None else [dim_key] if isinstance(dim_key, str) else list(dim_key)
    names = [f"_k{i}" for i in range(len(keys))]
    there = F.col(date).isNotNull()
    for k in keys:
        there = there & F.col(k).isNotNull()
    version = F.struct(F.col(end).alias("_to"), *(F.col(c).alias(f"{prefix}{c}") for c in cols))
    d = dim.filter(F.col(start) <= F.col(end)).select(*(F.col(k).alias(n) for k, n in zip(theirs, names, strict=True)), F.col(start).alias("_at"), F.lit(0).alias("_kind"), version.alias("_version"))
    f = fact.filter(there).select(*(F.col(k).alias(n) for k, n in zip(keys, names, strict=True)), F.col(date).alias("_at"), F.lit(1).alias("_kind"), F.struct(*fact.columns).alias("_fact"))
    both = f.unionByName(d, allowMissingColumns=True)
    last = lambda rows, some: scans.last_before(rows, names, ["_at", "_kind"], "_at", "_version", "_seen", some)
    if parts is None and cuts is None:
        seen = scans.by_size(both, names, lambda rows, some: last(rows, scans.cut_points(rows, "_at", some)))
    else:
        seen = last(both, scans.cut_points(fact, date, parts) if cuts is None else cuts)
    seen = seen.filter(F.col("_kind") == 1)
    holds = F.col("_seen._to") >= F.col("_at")
    found = seen.select("_fact.*", *(F.when(holds, F.col(f"_seen.{prefix}{c}")).alias(f"{prefix}{c}") for c in cols))
    return found.unionByName(fact.filter(~there), allowMissingColumns=True)


def dimension_join(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Plain left join; Spark broadcasts the dimension if it measures it as small."""
    return fact.join(dim.select(key, *cols), key, "left")


def enrich_check(df: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left sort-merge join that keeps the left columns only."""
    return df.join(dim.select(F.col(key).alias("_k")).hint("merge"), F.col(key) == F.col("_k"), "left").select(*(df[c] for c in df.columns))


def maybe_join(spark: SparkSession, df: DataFrame, name: str, key: str) -> DataFrame:
    """Left join to a catalog table, or df as it is if there is no such table."""
    return df.join(spark.table(name), key, "left") if spark.catalog.tableExists(name) else df


def delete_changed(target: DataFrame, updates: DataFrame, key: str, digest: str) -> DataFrame:
    """target without the rows whose key is updated and whose hash is not among the updates of that key."""
    new = updates.select(F.col(key).alias("_k"), F.col(digest).alias("_h"))
    t = target.join(new.select("_k").distinct(), F.col(key).eqNullSafe(F.col("_k")), "left_semi")
    stale = t.join(new.distinct(), F.col(key).eqNullSafe(F.col("_k")) & F.col(digest).eqNullSafe(F.col("_h")), "left_anti").select(F.col(key).alias("_k"), F.col(digest).alias("_h")).distinct()
    return target.join(stale, target[key].eqNullSafe(stale["_k"]) & target[digest].eqNullSafe(stale["_h"]), "left_anti")


def missing_keys(planned: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned rows that are not there yet."""
    return planned.join(present, list(keys), "left_anti")
