"""Descriptive statistics in long form: one row per variable and statistic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata.functions import finite_or_null

from .quantiles import approximate_quantiles, exact_quantiles

QUARTILES = (0.25, 0.5, 0.75)
STATS_SCHEMA = "variable string, stat string, value double"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as finite doubles, everything else null."""
    return df.select(*[finite_or_null(F.col(f"`{c}`").cast("double")).alias(c) for c in columns])


def moments(df: DataFrame, columns: Sequence[str] | None = None, keep_infinite: bool = False) -> DataFrame:
    """Count, mean, sample deviation, min, max and rows left out, all from one aggregate.

    Infinite values are left out and counted under ``excluded``; with
    ``keep_infinite`` they take part, which makes the mean infinite and the
    deviation NaN.
    """
    columns = list(columns or numeric_columns(df))
    structs = []
    for c in columns:
        given = F.col(f"`{c}`").cast("double")
        value = given if keep_infinite else finite_or_null(given)
        stats = {
            "count": F.count(value).cast("double"),
            "mean": F.avg(value),
            "std": F.stddev_samp(value),
            "min": F.min(value),
            "max": F.max(value),
            "excluded": (F.count(given) - F.count(value)).cast("double"),
        }
        structs += [F.struct(F.lit(c).alias("variable"), F.lit(s).alias("stat"), v.alias("value")) for s, v in stats.items()]
    return df.agg(F.array(*structs).alias("rows")).select(F.inline("rows"))


def quartiles(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Quartiles as ``variable, stat, value``; exact by default, sketched with ``approx``."""
    columns = list(columns or numeric_columns(df))
    pick = approximate_quantiles if approx else exact_quantiles
    found = pick(finite(df, columns), {c: QUARTILES for c in columns})
    rows = [(c, f"{q:.0%}", found[c][q]) for c in columns for q in QUARTILES]
    return df.sparkSession.createDataFrame(rows, STATS_SCHEMA)


def describe(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """The whole summary: moments and quartiles of the numeric columns."""
    columns = list(columns or numeric_columns(df))
    return moments(df, columns).unionByName(quartiles(df, columns, approx))
