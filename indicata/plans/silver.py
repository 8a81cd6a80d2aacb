"""Silver: one raw table to ``code`` and one value column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from indicata import names
from indicata.functions import CAST_MODES, key_text, round_scaled
from indicata.operators.columns import MissingColumns, require
from indicata.operators.joins import split_null_keys
from indicata.operators.rows import at_level, at_level_and_date, first_per_key
from indicata.sources.catalogue import Source
from indicata.sources.landing import ORDINAL

MODES = ("label", "strict")
STATE, GIVEN, CLEAN, REJECT = "state", "given", "clean", "reject"


def selected(raw: DataFrame, source: Source) -> DataFrame:
    """Municipality rows (of the date) as ``code``, value and landing position.

    The columns that the source is known to carry must be there even though only
    the key and the value are kept.
    """
    require(raw, source.key, source.value, *source.drops)
    if source.date_column is None:
        rows = at_level(raw, source.level_column, source.level)
    else:
        rows = at_level_and_date(raw, source.level_column, source.level, source.date_column, source.date)
    return rows.select(
        key_text(raw, source.key).alias(names.CODE),
        F.col(f"`{source.value}`").alias(source.name),
        ORDINAL,
    )


def silver(raw: DataFrame, source: Source, mode: str = "label") -> DataFrame:
    """The clean rows of a source; see ``silver_and_rejects``."""
    return _refined(selected(raw, source), source, mode)


def silver_and_rejects(raw: DataFrame, source: Source, mode: str = "label") -> tuple[DataFrame, DataFrame]:
    """Clean rows and the rows whose key is missing.

    ``label`` keeps repeated keys; ``strict`` keeps the first row of each. Only
    the key and the value leave silver, so later joins cannot clash on names.
    """
    rows = selected(raw, source)
    _, rejects = split_null_keys(rows, names.CODE)
    return _refined(rows, source, mode), rejects.select(names.CODE, source.name)


def silver_states(raw: DataFrame, source: Source, mode: str = "label") -> DataFrame:
    """Both in one table, for a write that reads the raw rows once: ``code``, the value, ``given`` (a rejected row's
    value as it came) and ``state``."""
    rows = selected(raw, source)
    missing, value = F.col(names.CODE).isNull(), F.col(source.name)
    told = {GIVEN: F.when(missing, value), STATE: F.when(missing, REJECT).otherwise(CLEAN)}
    rows = _cast(rows.withColumns({**told, source.name: F.when(~missing, value)}), source, mode)
    if mode == "strict":
        # Every rejected row is a key of its own.
        columns = [F.min_by(c, ORDINAL).alias(c) for c in (source.name, GIVEN, STATE)]
        rows = rows.groupBy(names.CODE, F.when(missing, F.col(ORDINAL)).alias("_row")).agg(*columns)
    return rows.select(names.CODE, _scaled(source).alias(source.name), GIVEN, STATE)


def _refined(rows: DataFrame, source: Source, mode: str) -> DataFrame:
    rows, _ = split_null_keys(rows, names.CODE)
    rows = _cast(rows, source, mode)
    if mode == "strict":
        rows = first_per_key(rows, names.CODE, ORDINAL)
    return rows.select(names.CODE, _scaled(source).alias(source.name))


def _cast(rows: DataFrame, source: Source, mode: str) -> DataFrame:
    if mode not in MODES:
        raise ValueError(f"mode {mode!r} is none of {MODES}")
    if source.dtype is not None:
        rows = CAST_MODES[source.casts[mode]](rows, source.name, source.dtype)
        if isinstance(rows.schema[source.name].dataType, T.StringType):
            raise MissingColumns(f"{source.value}: values that are no {source.dtype}")
    return rows


def _scaled(source: Source) -> Column:
    value = F.col(source.name)
    if source.scale is not None:
        value = value * F.lit(source.scale)
    if source.digits is not None:
        value = round_scaled(value, source.digits)
    return value
