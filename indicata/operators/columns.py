"""Column-level operators: strict drop, rename, re-index to a fixed schema."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class MissingColumns(ValueError):
    """A column that the operator needs is not in the input."""


def require(df: DataFrame, *columns: str) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumns(f"missing columns {absent}; have {df.columns}")


def drop_strict(df: DataFrame, *columns: str) -> DataFrame:
    """Drop columns; an absent one is an error (``DataFrame.drop`` ignores it)."""
    require(df, *columns)
    return df.drop(*columns)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; names that are not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def reindex(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema`` in its order: absent ones null, others dropped."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`") if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )
