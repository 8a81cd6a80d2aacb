"""Reads from the landing zone and keeps the order in which rows arrived.

Layout: ``<root>/<series>/...`` as Parquet or CSV files; yearly series are
partitioned by ``YEAR=<year>`` so that asking for one year lists one directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata import names
from indicata.functions import days_to_timestamp, nan_to_null, text_to_timestamp
from indicata.operators.columns import drop_strict, rename, require

from .catalogue import (
    OBSERVATION_YEAR,
    POLYGON_DROPS,
    POLYGON_KEY,
    POLYGON_SCHEMA,
    POLYGON_STATE,
    STATE,
    Source,
)

ORDINAL = "_ord"
# Written by other tools for a non-default row index; carries no data.
INDEX_ARTEFACT = "__index_level_0__"


class LandingZone:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def read(self, source: Source) -> DataFrame:
        """The raw rows of a source with a unique, repeatable position per row.

        Columns are found by name and keep the types they come in; silver casts them. A file
        without a known column, or one whose header differs from the others', is an error.
        """
        path = f"{self.root}/{source.series}"
        if self.fmt == "csv":
            # Every column is text. CSV files carry no row index; the position within a split is as stable.
            rows = self.spark.read.option("header", True).option("enforceSchema", False).option("encoding", "UTF-8").option("escape", '"').csv(path)
            place = [F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
            if source.dtype is not None and source.value in rows.columns:
                value = F.col(f"`{source.value}`")
                rows = rows.withColumn(source.value, F.when(F.lower(F.trim(value)) != "nan", value))
        else:
            rows = self.spark.read.parquet(path)
            place = [F.col("_metadata.row_index")]
        require(rows, *source.schema.names)
        if source.year is not None:
            rows = rows.where(F.col(OBSERVATION_YEAR) == source.year)
        rows = rows.select("*", F.struct(F.col("_metadata.file_path"), *place).alias(ORDINAL))
        return raw(text_to_timestamp(rows, source.date_column) if source.date_column else rows)

    def polygons(self, series: str = "polygons") -> DataFrame:
        """Territory polygons: integer key, state, geometry in well-known binary, and whatever else is known of them."""
        rows = self.spark.read.parquet(f"{self.root}/{series}")
        require(rows, *POLYGON_SCHEMA.names)
        return polygon_columns(rows)


def raw(rows: DataFrame) -> DataFrame:
    """Bronze normalisation: no index artefact, NaN as null, day numbers as timestamps."""
    rows = days_to_timestamp(rows, "date")
    return nan_to_null(rows.drop(INDEX_ARTEFACT) if INDEX_ARTEFACT in rows.columns else rows)


def polygon_columns(rows: DataFrame) -> DataFrame:
    kept = rename(drop_strict(rows, *POLYGON_DROPS), {POLYGON_STATE: STATE, POLYGON_KEY: names.CODE})
    return kept.withColumn(names.CODE, F.col(names.CODE).cast("bigint"))
