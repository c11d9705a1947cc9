"""Slowly changing dimensions, merges and incremental tables, as DataFrames in and out.

Tables are written as new versions beside the old one (``gamelake.sources.tables.write_version``), so a
merge never overwrites what it reads.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gamelake.functions.scalars import row_hash, row_hash256, surrogate_key
from gamelake.operators import scans, windows
from gamelake.operators.joins import delete_changed

SCD = ("record_start_date", "record_end_date", "is_current", "hash_val")


def _day(as_of: str | Column) -> Column:
    return F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of


def scd2_start(df: DataFrame, keys: Sequence[str], compare: Sequence[str], as_of: str | Column, order: Sequence[Column] | None = None) -> DataFrame:
    """A first version: every key current from ``as_of`` on; of a key's rows in the batch one stays."""
    one = windows.dedupe_latest(df, keys, order or [F.col(c).desc_nulls_last() for c in compare])
    return one.select(*df.columns, _day(as_of).alias(SCD[0]), F.lit(None).cast("date").alias(SCD[1]), F.lit(True).alias(SCD[2]), row_hash256(compare).alias(SCD[3]))


def scd2_merge(target: DataFrame, updates: DataFrame, keys: Sequence[str], compare: Sequence[str], as_of: str | Column, detector: str = "hash", order: Sequence[Column] | None = None) -> DataFrame:
    """target (business columns and the SCD columns) after a batch of updates.

    A current row whose compared columns changed is closed at ``as_of`` and its new version inserted in
    the same call; unseen keys are inserted; keys that the batch lacks, and unchanged ones, stay. The
    same batch twice changes nothing more. One full outer join on the keys; history passes by it.
    detector: "hash" compares SHA-256 hashes, "columns" compares column by column, nulls as values."""
    new = scd2_start(updates, keys, compare, as_of, order)
    business = [c for c in target.columns if c not in SCD]
    old, history = target.filter(SCD[2]), target.filter(f"not {SCD[2]}")
    o = old.select(*(F.col(c).alias(f"o_{c}") for c in target.columns), F.lit(True).alias("o_there"))
    n = new.select(*(F.col(c).alias(f"n_{c}") for c in new.columns), F.lit(True).alias("n_there"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}"))
    j = o.join(n, cond, "full_outer")
    both = F.col("o_there").isNotNull() & F.col("n_there").isNotNull()
    if detector == "hash":
        differs = ~F.col(f"o_{SCD[3]}").eqNullSafe(F.col(f"n_{SCD[3]}"))
    else:
        differs = F.lit(False)
        for c in compare:
            differs = differs | ~F.col(f"o_{c}").eqNullSafe(F.col(f"n_{c}"))
    changed = both & differs
    kept = F.struct(*(F.col(f"o_{c}").alias(c) for c in business), F.col(f"o_{SCD[0]}").alias(SCD[0]), F.when(changed, _day(as_of)).otherwise(F.col(f"o_{SCD[1]}")).alias(SCD[1]), (~changed).alias(SCD[2]), F.col(f"o_{SCD[3]}").alias(SCD[3]))
    added = F.struct(*(F.col(f"n_{c}").alias(c) for c in business), *(F.col(f"n_{c}").alias(c) for c in SCD))
    rows = F.filter(F.array(F.when(F.col("o_there").isNotNull(), kept), F.when(F.col("n_there").isNotNull() & (F.col("o_there").isNull() | changed), added)), lambda r: r.isNotNull())
    return j.select(F.inline(rows)).unionByName(history)


def scd2_from_events(df: DataFrame, keys: Sequence[str], date: str, attrs: Sequence[str], order: Sequence[str | Column] = (), parts: int | None = None, cuts: Sequence[float] | None = None) -> DataFrame:
    """One row per block of constant attributes: start_date, end_date, next_start (of the next block),
    is_current (the key's last block), row_hash and version_key.

    The blocks of a large key are numbered over segments of dates (``scans``), grouped, and each meets the next
    one by its number, so no step holds its history in one task; those of other keys are windows by key
    after one shuffle. df is read more than once."""
    if parts is None and cuts is None:
        return scans.by_size(df, keys, lambda rows, some: scd2_from_events(rows, keys, date, attrs, order, some))
    total = [F.col(date), *order, *(F.col(a) for a in attrs)]
    blocks = windows.block_ranges(scans.block_ids(df, keys, total, date, attrs, parts=parts, cuts=cuts), keys, date, attrs)
    if parts == 1 and cuts is None:
        after = F.lead("start_date").over(Window.partitionBy(*keys).orderBy("block"))
        last = F.lead(F.lit(True)).over(Window.partitionBy(*keys).orderBy("block")).isNull()
        out = blocks.withColumns({"next_start": after, "is_current": last})
        return out.withColumns({"row_hash": row_hash([*keys, *attrs]), "version_key": surrogate_key([*keys, "block"])})
    after = blocks.select(*(F.col(k).alias(f"_{k}") for k in keys), (F.col("block") - 1).alias("_block"), F.col("start_date").alias("next_start"), F.lit(True).alias("_there"))
    meets = F.col("block") == F.col("_block")
    for k in keys:
        meets = meets & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = blocks.join(after, meets, "left").withColumn("is_current", F.col("_there").isNull()).drop("_block", "_there", *(f"_{k}" for k in keys))
    return out.withColumns({"row_hash": row_hash([*keys, *attrs]), "version_key": surrogate_key([*keys, "block"])})


def merge_events(history: DataFrame, old_events: DataFrame, new_events: DataFrame, keys: Sequence[str], date: str, attrs: Sequence[str]) -> DataFrame:
    """``history`` after late or new events: only the keys that they touch are built again."""
    touched = new_events.select(*keys).distinct()
    again = scd2_from_events(old_events.join(touched, list(keys), "left_semi").unionByName(new_events), keys, date, attrs)
    return history.join(touched, list(keys), "left_anti").unionByName(again)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """target with the updates in place of rows with their keys; of a key's updates the first in order."""
    new = windows.dedupe_latest(updates, keys, order)
    cond = F.lit(True)
    n = new.select(*(F.col(k).alias(f"_{k}") for k in keys))
    for k in keys:
        cond = cond & target[k].eqNullSafe(n[f"_{k}"])
    return target.join(n, cond, "left_anti").unionByName(new)


def replace_changed(target: DataFrame, updates: DataFrame, key: str, digest: str) -> DataFrame:
    """Delete the rows that changed, then insert the updates that are not there yet, by key and hash."""
    left = delete_changed(target, updates, key, digest)
    there = left.select(F.col(key).alias("_k"), F.col(digest).alias("_h")).distinct()
    return left.unionByName(updates.distinct().join(there, F.col(key).eqNullSafe(F.col("_k")) & F.col(digest).eqNullSafe(F.col("_h")), "left_anti"))


def snapshot_check(target: DataFrame, source: DataFrame, key: Sequence[str], check: Sequence[str], as_of: str | Column) -> DataFrame:
    """Snapshot with the check-columns strategy."""
    return scd2_merge(target, source, key, check, as_of, detector="columns")


def audit(df: DataFrame, by: str, at: str | Column) -> DataFrame:
    stamp = F.to_timestamp(F.lit(at)) if isinstance(at, str) else at
    return df.withColumns({"created_by": F.lit(by), "created_at": stamp, "updated_at": stamp})
