"""Projections, filters and conforming of tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gamelake.functions.scalars import clean_double


def parse_json(df: DataFrame, schema: str | T.StructType, keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """The typed fields of a JSON text column, beside the kept columns (topic, partition, offset ...)."""
    return df.select(*keep, F.from_json(F.col(value), schema).alias("data")).select(*keep, "data.*")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of the schema, cast to its types; missing ones are null."""
    have = set(df.columns)
    return df.select(*((F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema))


def add_date_parts(df: DataFrame, date: str, pattern: str | None = None) -> DataFrame:
    """The column as a date, with year, month and day."""
    d = F.to_date(date, pattern) if pattern else F.to_date(date)
    return df.withColumn(date, d).withColumns({"year": F.year(date), "month": F.month(date), "day": F.dayofmonth(date)})


def fill_numeric(df: DataFrame) -> DataFrame:
    """Nulls as 0 in integer and double columns only."""
    return df.fillna(0, subset=[f.name for f in df.schema if isinstance(f.dataType, (T.IntegerType, T.LongType, T.DoubleType))])


def current_rows(df: DataFrame, flag: str = "is_current") -> DataFrame:
    return df.filter(F.col(flag))


def latest_season(df: DataFrame, season: str) -> DataFrame:
    """Rows of the latest season, by the first four characters of its name. The maximum is a scalar
    subquery, so it is one value in the scan's filter."""
    year = F.substring(F.col(season).cast("string"), 1, 4).cast("int")
    return df.filter(year == df.agg(F.max(year)).scalar())


def sane(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Rows with a key and a measure that is not negative."""
    return df.filter(F.col(key).isNotNull() & (F.col(measure) >= 0))


def like(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).like(pattern))


def validated_events(df: DataFrame) -> DataFrame:
    """Events with one parsed pair whose sides are both known and differ."""
    return df.filter((F.col("pairs") == 1) & F.col("home_id").isNotNull() & F.col("away_id").isNotNull() & (F.col("home_id") != F.col("away_id")))


def numeric_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def strip_prefix(df: DataFrame, regex: str) -> DataFrame:
    """Column names without the prefix; names that would meet are an error."""
    names = [re.sub(f"^(?:{regex})", "", c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"columns would have the same name: {sorted(n for n in set(names) if names.count(n) > 1)}")
    return df.toDF(*names)


def extend_schema(base: T.StructType, names: Sequence[str], kind: T.DataType | None = None) -> T.StructType:
    """base with a field for each name that it lacks."""
    have = {f.name for f in base}
    return T.StructType([*base, *(T.StructField(n, kind or T.StringType()) for n in dict.fromkeys(names) if n not in have)])


def tag(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def winsorize(df: DataFrame, cols: Sequence[str], low: float = 0.05, high: float = 0.95, accuracy: int = 10_000) -> DataFrame:
    """Columns cut at their approximate percentiles, all found by one scalar subquery."""
    bounds = df.agg(F.struct(*(F.percentile_approx(c, [low, high], accuracy).alias(c) for c in cols))).scalar()
    return df.withColumns({c: F.least(F.greatest(F.col(c), bounds[c][0]), bounds[c][1]) for c in cols})


def clean_doubles(df: DataFrame) -> DataFrame:
    """Null, NaN and infinities as 0 in double columns, in one projection."""
    return df.select(*(clean_double(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f"`{f.name}`") for f in df.schema))


def ensure_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    missing = {c: F.lit(0.0) for c in cols if c not in df.columns}
    return df.withColumns(missing) if missing else df


def one_hot(df: DataFrame, col: str, values: Sequence[str]) -> DataFrame:
    """A 0/1 column for each listed value, so that fitted and scored tables are aligned."""
    return df.withColumns({f"{col}_{re.sub(r'[^0-9A-Za-z]+', '_', v)}": F.coalesce((F.col(col) == v).cast("int"), F.lit(0)) for v in values})


def future_rows(df: DataFrame, date: str, as_of: str | Column) -> DataFrame:
    """Rows dated after ``as_of``."""
    day = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return df.filter(F.to_date(date) >= F.date_add(day, 1))


def historical_rows(df: DataFrame, date: str, as_of: str | Column) -> DataFrame:
    day = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return df.filter(F.to_date(date) < F.date_add(day, 1))


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def dots_to_underscores(df: DataFrame) -> DataFrame:
    """Column names with literal dots, flattened."""
    return df.select(*(F.col(f"`{c}`").alias(c.replace(".", "_")) for c in df.columns))


def row_id(df: DataFrame, key: Sequence[str], name: str = "row_id") -> DataFrame:
    """A 64-bit id from the key's hash: the same in every run, unlike a counter."""
    return df.withColumn(name, F.xxhash64(*key))
