"""Row-level operators: level and date filters, completeness, first row per key, sort."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import require
from .quantiles import exact_quantiles


def at_level(df: DataFrame, column: str, level: str) -> DataFrame:
    """Rows of one territory level (case-sensitive; null never matches)."""
    return df.where(F.col(f"`{column}`") == F.lit(level))


def at_level_and_date(
    df: DataFrame, level_column: str, level: str, date_column: str, day: dt.date
) -> DataFrame:
    """Rows of one level at exactly midnight of ``day``."""
    midnight = F.lit(dt.datetime.combine(day, dt.time())).cast("timestamp_ntz")
    return at_level(df, level_column, level).where(F.col(f"`{date_column}`") == midnight)


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Drop rows with a null (or NaN) in any column."""
    return df.dropna(how="any")


def trim_upper(df: DataFrame, column: str, fraction: float = 0.95) -> DataFrame:
    """Rows at or below the exact ``fraction`` quantile of a column."""
    bound = exact_quantiles(df, {column: [fraction]})[column][fraction]
    if bound is None:
        return df.where("false")
    return df.where(F.col(f"`{column}`") <= F.lit(bound))


def first_per_key(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """The row with the smallest ``ordinal`` of every key; the ordinal column is consumed.

    One aggregate with map-side combine: a key that holds much of the table is
    reduced to one row per task before the shuffle. ``ordinal`` has to be unique
    within a key, such as the position of a row in its landing file.
    """
    require(df, key, ordinal)
    rest = [c for c in df.columns if c not in (key, ordinal)]
    firsts = [F.min_by(F.col(f"`{c}`"), F.col(f"`{ordinal}`")).alias(c) for c in rest]
    if not firsts:
        return df.select(key).distinct()
    return df.groupBy(key).agg(*firsts)


def sorted_by_key(df: DataFrame, key: str) -> DataFrame:
    """Global ascending sort by key, missing last.

    The other columns break ties. That leaves the order by key untouched and lets
    the range partitioner cut inside a key that holds a large share of the rows.
    """
    return df.orderBy(*sort_columns(df, key))


def sort_columns(df: DataFrame, key: str) -> list[Column]:
    ordered = [key, *[c for c in df.columns if c != key]]
    return [F.col(f"`{c}`").asc_nulls_last() for c in ordered]
