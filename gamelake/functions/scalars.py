"""Scalar expressions: parsing, hashing, keys, rounding, labels. All are built-in column functions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def split_part_trim(c: Column, sep: str, part: int) -> Column:
    """The part-th piece (from 1) between separators, without blanks around it."""
    return F.trim(F.split_part(c, F.lit(sep), F.lit(part)))


def home_away(matchup: Column) -> tuple[Column, Column]:
    """(home, away) of "A @ B" (A plays at B) or "A vs. B" (A is at home); null for anything else."""
    at, versus = matchup.contains(" @ "), matchup.contains(" vs. ")
    home = F.when(at, split_part_trim(matchup, " @ ", 2)).when(versus, split_part_trim(matchup, " vs. ", 1))
    away = F.when(at, split_part_trim(matchup, " @ ", 1)).when(versus, split_part_trim(matchup, " vs. ", 2))
    return home, away


def _texts(cols: Sequence[str | Column], null: str) -> list[Column]:
    return [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(null)) for c in cols]


def row_hash(cols: Sequence[str | Column], null: str = "_null_") -> Column:
    """MD5 of the columns' texts joined by "-"; nulls count as their own text, so that they keep their place."""
    return F.md5(F.concat_ws("-", *_texts(cols, null)))


def row_hash256(cols: Sequence[str | Column], null: str = "_null_") -> Column:
    """SHA-256 of the columns' texts joined by "||", nulls as in ``row_hash``."""
    return F.sha2(F.concat_ws("||", *_texts(cols, null)), 256)


def surrogate_key(cols: Sequence[str | Column]) -> Column:
    """Lower-case hexadecimal MD5 key."""
    return F.md5(F.concat_ws("_", *_texts(cols, "_null_")))


def readable_key(cols: Sequence[str | Column]) -> Column:
    return F.concat_ws("_", *_texts(cols, "_null_"))


def safe_ratio(n: Column, d: Column, digits: int = 3, zero: float | None = None) -> Column:
    """n / d in doubles, rounded last; ``zero`` where d is zero or null."""
    empty = F.coalesce(d == 0, F.lit(True))
    return F.when(empty, F.lit(zero).cast("double")).otherwise(F.round(n.cast("double") / d.cast("double"), digits))


def whole_ratio(n: Column, d: Column, digits: int = 4) -> Column:
    """As ``safe_ratio`` for whole numbers (below 10^11), with 0 where d is zero or null: n 10^digits / d is
    a tie if and only if its double is one, so that adding a half rounds as decimals do, at a small part of
    their cost."""
    q = n.cast("double") * float(10**digits) / F.when(d != 0, d.cast("double"))
    return F.coalesce((q + F.signum(q) * 0.5).cast("long") / float(10**digits), F.lit(0.0))


def possessions(fga: Column, fta: Column, tov: Column) -> Column:
    """Estimated possessions: attempts, 0.44 of the free throws, turnovers."""
    return fga.cast("double") + 0.44 * fta.cast("double") + tov.cast("double")


def pct_clean(c: Column, full_as_100: bool = False) -> Column:
    """Half-up to three decimals, null as 0; optionally exactly 1.0 as 100.0."""
    x = F.floor(F.coalesce(c.cast("double"), F.lit(0.0)) * 1000 + 0.5) / 1000
    return F.when(x == 1.0, F.lit(100.0)).otherwise(x) if full_as_100 else x


def rate(n: Column, d: Column, eps: float | None = None) -> Column:
    """n per d; with ``eps`` added to d, or 0 where d is not positive."""
    n, d = n.cast("double"), d.cast("double")
    return n / (d + F.lit(eps)) if eps is not None else F.when(d > 0, n / d).otherwise(0.0)


def protected_log(c: Column) -> Column:
    """Logarithm with values of zero or below taken as one."""
    return F.log(F.when(c > 0, c.cast("double")).otherwise(F.lit(1.0)))


def log_plus_one(c: Column) -> Column:
    """Logarithm of one plus the value; negative values count as zero."""
    return F.log1p(F.greatest(c.cast("double"), F.lit(0.0)))


def basic_transforms(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """abs, square, protected log, log plus one and square root of each column, in one projection."""
    new: dict[str, Column] = {}
    for c in cols:
        x = F.col(c).cast("double")
        new |= {f"{c}_abs": F.abs(x), f"{c}_square": x * x, f"{c}_log": protected_log(x), f"{c}_log1p": log_plus_one(x), f"{c}_sqrt": F.sqrt(F.greatest(x, F.lit(0.0)))}
    return df.withColumns(new)


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def ordinal(day: Column) -> Column:
    """1st, 2nd, 3rd, 4th ... with 11th to 13th."""
    last, teens = day % 10, (day % 100).between(11, 13)
    suffix = F.when(teens, "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(day.cast("string"), suffix)


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Mapped values; others fall through."""
    out = F.lit(None).cast("string")
    for old, new in mapping.items():
        out = F.when(c == old, new).otherwise(out)
    return F.coalesce(out, c)


#: Canonical codes of season types, from their URL-encoded names and short forms.
SEASON_TYPES = {"Regular%20Season": "regular_season", "Regular Season": "regular_season", "Playoffs": "playoffs", "Pre%20Season": "pre_season", "Pre Season": "pre_season", "PlayIn": "play_in", "All%20Star": "all_star", "IST": "nba_cup"}


def bucket3(c: Column, low: float = -10, high: float = 10) -> Column:
    """LOW below low, MED up to high, HIGH above; null is HIGH."""
    return F.when(c < low, "LOW").when(c <= high, "MED").otherwise("HIGH")


def rank_tier(rank: Column) -> Column:
    """Tiers of a standing: up to 6, 7 to 10, the rest."""
    return F.when(rank <= 6, "PLAYOFF").when(rank <= 10, "PLAY_IN").otherwise("LOTTERY")


def binary_label(c: Column, positive: str) -> Column:
    return F.when(c == positive, 1).otherwise(0)


def decode_prediction(probability: Column, threshold: float = 0.5, labels: tuple[str, str] = ("loss", "win")) -> Column:
    return F.when(probability >= threshold, labels[1]).otherwise(labels[0])


def count_reaching(cols: Sequence[Column], threshold: float) -> Column:
    """How many of the columns reach the threshold."""
    out = F.lit(0)
    for c in cols:
        out = out + F.when(c >= threshold, 1).otherwise(0)
    return out


def multi_double_label(cols: Sequence[Column], threshold: float = 10) -> Column:
    n = count_reaching(cols, threshold)
    return F.when(n >= 4, "quadruple-double").when(n == 3, "triple-double").when(n == 2, "double-double").otherwise("none")


def clean_double(c: Column) -> Column:
    """Null, NaN and infinities as 0."""
    bad = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(bad, 0.0).otherwise(c)
