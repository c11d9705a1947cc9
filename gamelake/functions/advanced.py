"""Advanced statistics as column expressions: doubles, zero denominators give 0, rounded last to four places."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gamelake.functions.scalars import possessions, safe_ratio, whole_ratio

#: Statistics whose share of a group or of a whole event is computed.
SHARES = ("fg3a", "fg3m", "ast", "stl", "tov", "pts", "fga", "fgm", "fta", "ftm", "oreb", "dreb", "reb", "blk")


def _ratio(n: Column, d: Column, digits: int = 4) -> Column:
    return safe_ratio(n, d, digits, 0.0)


def true_shooting(pts: Column, fga: Column, fta: Column) -> Column:
    return _ratio(pts, 2 * (fga.cast("double") + 0.44 * fta.cast("double")))


def effective_fg(fgm: Column, fg3m: Column, fga: Column) -> Column:
    return _ratio(fgm.cast("double") + 0.5 * fg3m.cast("double"), fga)


def usage(fga: Column, fta: Column, tov: Column, group_fga: Column, group_fta: Column, group_tov: Column) -> Column:
    """Per cent of the group's possessions that the member ends."""
    return _ratio(100 * possessions(fga, fta, tov), possessions(group_fga, group_fta, group_tov))


def shares(own: str, whole: str, suffix: str, stats: Sequence[str] = SHARES) -> list[Column]:
    """own_x / whole_x for each statistic; the arguments are prefixes with their dot, if any."""
    return [_ratio(F.col(f"{own}{s}"), F.col(f"{whole}{s}")).alias(f"{s}_{suffix}") for s in stats]


def game_shares(own: str, other: str, suffix: str, stats: Sequence[str] = SHARES, whole: bool = False) -> list[Column]:
    """own_x / (own_x + other_x); a missing opponent counts as 0. whole: statistics are whole numbers."""
    ratio = whole_ratio if whole else _ratio
    return [ratio(F.col(f"{own}{s}"), F.col(f"{own}{s}") + F.coalesce(F.col(f"{other}{s}"), F.lit(0))).alias(f"{s}_{suffix}") for s in stats]


def group_rates(p: str = "") -> list[Column]:
    """Three-point rate, turnover per cent, offensive rating and free-throw rate."""
    c = lambda s: F.col(f"{p}{s}")
    poss = possessions(c("fga"), c("fta"), c("tov"))
    return [
        _ratio(c("fg3a"), c("fga")).alias("three_point_rate"),
        _ratio(c("tov"), poss).alias("turnover_pct"),
        _ratio(100 * c("pts"), poss).alias("offensive_rating"),
        _ratio(c("fta"), c("fga")).alias("free_throw_rate"),
    ]
