"""What to ingest next: high-water marks, date chunks, chunks that failed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def high_water_mark(df: DataFrame, date: str, default: str) -> DataFrame:
    """One row: the last event date, or the default if there is none."""
    return df.agg(F.coalesce(F.max(F.to_date(date)), F.to_date(F.lit(default))).alias("high_water_mark"))


def high_water_marks(df: DataFrame, wanted: DataFrame, key: str, date: str, default: str) -> DataFrame:
    """key, high_water_mark for each wanted key (one row each): one grouping of df, whatever their number."""
    last = df.groupBy(key).agg(F.max(F.to_date(date)).alias("high_water_mark"))
    return wanted.select(key).join(last, key, "left").select(key, F.coalesce("high_water_mark", F.to_date(F.lit(default))).alias("high_water_mark"))


def advance_mark(old: DataFrame, rows: DataFrame, date: str) -> DataFrame:
    """The mark after a batch: it moves forward, and only if rows came."""
    return old.select(F.greatest("high_water_mark", rows.agg(F.max(F.to_date(date))).scalar()).alias("high_water_mark"))


def season_bounds(seasons: DataFrame, start_year: str = "start_year") -> DataFrame:
    """Seasons run from October 1st to June 30th of the next year."""
    y = F.col(start_year)
    return seasons.withColumns({"season_start": F.make_date(y, F.lit(10), F.lit(1)), "season_end": F.make_date(y + 1, F.lit(6), F.lit(30))})


def date_chunks(ranges: DataFrame, start: str, end: str, days: int = 730) -> DataFrame:
    """Each range in pieces of at most so many days."""
    starts = F.explode(F.sequence(start, end, F.make_interval(days=F.lit(days))))
    cut = ranges.withColumn("chunk_start", starts)
    return cut.withColumn("chunk_end", F.least(F.date_add("chunk_start", days - 1), F.col(end)))


def missing_chunks(planned: DataFrame, loaded: DataFrame) -> DataFrame:
    return planned.join(loaded, ["chunk_start", "chunk_end"], "left_anti")
