"""Centred cross-products of many columns from one scan.

A task turns every batch of rows into matrices - rows, means, squares and products of every
pair of columns, over the rows where both are present and finite - and merges them pairwise.
The tasks' matrices are merged in groups, so that no task and not the driver holds more than a few.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Matrices merged by one task, and rows whose matrices are made at once.
FAN_IN, ROWS = 32, 8192


@dataclass
class Moments:
    """For every pair (i, j): rows, mean of i, centred squares of i, centred products of i and j."""

    rows: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    @staticmethod
    def none(k: int) -> Moments:
        return Moments(*(np.zeros((k, k)) for _ in range(4)))

    @staticmethod
    def of(x: np.ndarray) -> Moments:
        """Of a block of rows; what is not finite is missing."""
        there = np.isfinite(x)
        count = np.maximum(there.sum(axis=0), 1)
        centre = np.where(there, x, 0.0).sum(axis=0) / count
        away = np.where(there, x - centre, 0.0)
        seen = there.astype(np.float64)
        rows = seen.T @ seen
        some = np.maximum(rows, 1.0)
        sums = away.T @ seen
        squares = (away * away).T @ seen - sums * sums / some
        return Moments(rows, np.where(rows > 0, centre[:, None] + sums / some, 0.0), np.maximum(squares, 0.0), away.T @ away - sums * sums.T / some)

    def merged(self, other: Moments) -> Moments:
        rows = self.rows + other.rows
        step = np.where((self.rows > 0) & (other.rows > 0), other.mean - self.mean, 0.0)
        weight = self.rows * other.rows / np.maximum(rows, 1.0)
        mean = np.where(self.rows > 0, self.mean + step * other.rows / np.maximum(rows, 1.0), other.mean)
        return Moments(rows, mean, self.squares + other.squares + step * step * weight, self.products + other.products + step * step.T * weight)

    def batch(self, part: int) -> pa.RecordBatch:
        values = [pa.array([m.ravel()], pa.list_(pa.float64())) for m in (self.rows, self.mean, self.squares, self.products)]
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), *values], FIELDS)

    @staticmethod
    def read(row: dict) -> Moments:
        k = round(len(row["rows"]) ** 0.5)
        return Moments(*(np.array(row[f], dtype=np.float64).reshape(k, k) for f in FIELDS[1:]))

    def correlation(self) -> np.ndarray:
        """Pearson coefficients; NaN where one of the two has no spread."""
        with np.errstate(invalid="ignore", divide="ignore"):
            r = np.clip(self.products / (np.sqrt(self.squares) * np.sqrt(self.squares.T)), -1.0, 1.0)
        known = (self.squares > 0) & (self.squares.T > 0)
        return np.where(known, np.where(np.eye(len(r), dtype=bool), 1.0, r), np.nan)


FIELDS = ["part", "rows", "mean", "squares", "products"]
SCHEMA = "part long, rows array<double>, mean array<double>, squares array<double>, products array<double>"


def cross_moments(df: DataFrame, columns: Sequence[str]) -> Moments:
    """The moments of all pairs of ``columns``, pairwise complete, from one scan of ``df``."""
    k = len(columns)

    def measured(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Moments.none(k)
        for batch in source:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns]) if k else np.zeros((batch.num_rows, 0))
            for start in range(0, len(x), ROWS):
                total = total.merged(Moments.of(x[start : start + ROWS]))
        yield total.batch(TaskContext.get().partitionId())

    def merge(rows: pa.Table) -> pa.Table:
        total = Moments.none(k)
        for row in sorted(rows.to_pylist(), key=lambda r: r["part"]):
            total = total.merged(Moments.read(row))
        return pa.Table.from_batches([total.batch(rows["part"][0].as_py() // FAN_IN)])

    values = df.select(*(F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)))
    found = values.mapInArrow(measured, SCHEMA)
    for _ in range(3):  # FAN_IN to the third power tasks
        found = found.groupBy(F.floor(F.col("part") / FAN_IN).alias("_group")).applyInArrow(merge, SCHEMA)
    total = Moments.none(k)
    for row in found.orderBy("part").toLocalIterator():
        total = total.merged(Moments.read(row.asDict()))
    return total
