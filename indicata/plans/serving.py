"""Serving table: gold with state and simplified outline of every territory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import names
from indicata.operators.geometry import from_wkb, join_geometry, simplify, to_wkb

TOLERANCE = 0.01


def serving(gold: DataFrame, polygons: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """Left join of gold and polygons with the outline simplified.

    Outlines are simplified before the join: once per polygon rather than once
    per joined row, and the join then moves the smaller shape.
    """
    small = simplify(polygons, "geometry", tolerance)
    return join_geometry(gold, small, names.CODE)


def serving_wkb(gold: DataFrame, polygons: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """The same for polygons in well-known binary, which the result keeps."""
    small = simplify(polygons.withColumn("geometry", from_wkb(F.col("geometry"))), "geometry", tolerance)
    return join_geometry(gold, small.withColumn("geometry", to_wkb(F.col("geometry"))), names.CODE)
