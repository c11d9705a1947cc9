"""Rows as text: sentences, profiles, concatenations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gamelake.functions.scalars import month_name, ordinal


def date_text(date: Column) -> Column:
    """For example: October 22nd, 2024."""
    return F.concat(month_name(date), F.lit(" "), ordinal(F.dayofmonth(date)), F.lit(", "), F.year(date).cast("string"))


def counted(n: Column, one: str, many: str, none: str) -> Column:
    """A sentence for no, one or several; ``many`` holds {n}."""
    before, _, after = many.partition("{n}")
    return F.when(F.coalesce(n, F.lit(0)) == 0, none).when(n == 1, one).otherwise(F.concat(F.lit(before), n.cast("string"), F.lit(after)))


def row_sentences(df: DataFrame, subject: str, templates: Mapping[str, tuple[str, str, str]], suffix: str = "_text") -> DataFrame:
    """A sentence column per statistic, from a table of (none, one, many) texts after the subject."""
    return df.withColumns({f"{c}{suffix}": F.concat_ws(" ", F.col(subject).cast("string"), counted(F.col(c), one, many, none)) for c, (none, one, many) in templates.items()})


def profile_text(df: DataFrame, labels: Mapping[str, str], sep: str = "; ", name: str = "profile") -> DataFrame:
    """One labelled text per row; null values are left out and booleans are Yes or No."""
    kinds = dict(df.dtypes)
    value = lambda c: F.when(F.col(c), "Yes").otherwise("No") if kinds[c] == "boolean" else F.col(c).cast("string")
    return df.withColumn(name, F.concat_ws(sep, *(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{label}: "), value(c))) for c, label in labels.items())))


def row_text(df: DataFrame, cols: Sequence[str] | None = None, name: str = "row_text") -> DataFrame:
    """All columns' texts, joined by blanks."""
    return df.withColumn(name, F.concat_ws(" ", *(F.col(f"`{c}`").cast("string") for c in cols or df.columns)))
