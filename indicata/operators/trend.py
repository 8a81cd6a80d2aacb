"""Chart data for a scatter plot with a regression line and its bootstrap band."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import finite_or_null


GRID = 100
REPLICATES = 1000
# Rows whose weights in all replicates are drawn at once.
ROWS_AT_ONCE = 1024
# A prime below 2^31: products with a replicate number stay far inside 64 bits.
MODULUS = 2_147_483_647


def points(df: DataFrame, x: str, y: str, *extra: Column) -> DataFrame:
    """Every complete and finite (x, y) pair."""
    pair = [finite_or_null(F.col(f"`{c}`").cast("double")).alias(shown) for c, shown in ((x, "x"), (y, "y"))]
    pairs = df.select(*pair, *extra)
    return pairs.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def sampled_points(df: DataFrame, x: str, y: str, key: str | None, most: int) -> DataFrame:
    """The ``most`` (x, y) pairs whose unit (``key``; the row's values where that is None or null) has the smallest digest.

    The same points in every run and for any partitioning. A bound on the digest leaves about twice as many rows to
    be sorted, so what single tasks hand on does not grow with the table.
    """
    pairs = points(df, x, y, _digest(x, y, key))
    count = pairs.count()
    part, whole, share = F.conv(F.substring("digest", 1, 15), 16, 10).cast("bigint"), 16**15, 2 * most / max(count, 1)
    cut = pairs
    while share < 1:
        cut = pairs.where(part < int(whole * share))
        if cut.count() >= most:
            break
        cut, share = pairs, 2 * share
    return cut.orderBy("digest", "x", "y").limit(most).select("x", "y")


def _digest(x: str, y: str, key: str | None) -> Column:
    row_text = F.concat_ws(" ", F.lit("row"), F.col(f"`{x}`").cast("string"), F.col(f"`{y}`").cast("string"))
    unit = row_text if key is None else F.coalesce(F.col(f"`{key}`").cast("string"), row_text)
    return F.md5(unit.cast("binary")).alias("digest")


def trend_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: slope, intercept, r2, rows and the range of x."""
    return points(df, x, y).agg(
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"),
        F.regr_count("y", "x").alias("n"),
        F.min("x").alias("x_min"),
        F.max("x").alias("x_max"),
    )


def _grid_x(position: Column, low: Column, high: Column, grid: int) -> Column:
    return low + (high - low) * position / F.lit(float(grid - 1))


def trend_line(df: DataFrame, x: str, y: str, grid: int = GRID) -> DataFrame:
    """``(position, x, y)``: the fitted line at ``grid`` points over the range of x; null heights where none can be fitted."""
    fitted = trend_fit(df, x, y)
    rows = fitted.withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    at = _grid_x(F.col("position"), F.col("x_min"), F.col("x_max"), grid)
    return rows.select("position", at.alias("x"), (F.col("intercept") + F.col("slope") * at).alias("y"))


def _poisson_thresholds() -> list[int]:
    """Cumulative Poisson(1) probabilities on the scale of the modulus."""
    out, mass, total, k = [], math.exp(-1.0), 0.0, 0
    while True:
        total += mass
        bound = math.floor(total * MODULUS)
        if bound >= MODULUS - 1:
            return out
        out.append(bound)
        k += 1
        mass /= k


MOMENTS = ("s", "su", "sv", "suu", "suv")


def _resampled(replicates: int):
    """Sums of weighted moments of a task's rows (``u, v, a, b``), one row for each replicate."""
    thresholds = np.array(_poisson_thresholds(), dtype=np.int64)
    numbers = np.arange(replicates, dtype=np.int64)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((replicates, len(MOMENTS))), False
        for batch in source:
            u, v, a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("u", "v", "a", "b"))
            for start in range(0, len(u), ROWS_AT_ONCE):
                seen, part = True, slice(start, start + ROWS_AT_ONCE)
                draws = (a[part, None] * numbers + b[part, None]) % MODULUS
                weights = np.searchsorted(thresholds, draws, side="right").astype(np.float64)
                x, y = u[part], v[part]
                total += weights.T @ np.column_stack([np.ones(len(x)), x, y, x * x, x * y])
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), *(pa.array(c) for c in total.T.copy())], ["replicate", *MOMENTS])

    return batches


def trend_band(
    df: DataFrame,
    x: str,
    y: str,
    key: str | None,
    grid: int = GRID,
    replicates: int = REPLICATES,
    level: float = 0.95,
) -> DataFrame:
    """``(position, x, low, high)``: bootstrap confidence band of the trend line.

    A Poisson bootstrap over units: a unit (``key``; each row by its values where that is None or null) has a
    weight in replicate r that follows from (a*r + b) mod p, with a and b from the unit's digest, so a recomputed
    task draws the same weights. A task multiplies the matrix of weights (rows by replicates) with the rows' moments and
    hands on the sums of every replicate. Where no line can be fitted the ends are null.
    """
    pairs = points(df, x, y, _digest(x, y, key))
    centre = pairs.agg(F.avg("x"), F.avg("y"), F.min("x"), F.max("x"), F.count(F.lit(1))).first()
    if centre[4] < 2 or centre[2] == centre[3]:
        missing = [F.lit(None).cast("double").alias(c) for c in ("x", "low", "high")]
        return df.sparkSession.range(grid).select(F.col("id").cast("int").alias("position"), *missing)
    mean_x, mean_y, low, high = (F.lit(v) for v in centre[:4])

    def from_digest(start: int, modulus: int) -> Column:
        return F.conv(F.substring("digest", start, 8), 16, 10).cast("bigint") % modulus

    units = pairs.select(
        (F.col("x") - mean_x).alias("u"), (F.col("y") - mean_y).alias("v"), (from_digest(1, MODULUS - 1) + 1).alias("a"), from_digest(9, MODULUS).alias("b")
    )
    found = units.mapInArrow(_resampled(replicates), "replicate int, s double, su double, sv double, suu double, suv double")
    sums = found.groupBy("replicate").agg(*(F.sum(m).alias(m) for m in MOMENTS))
    spread = F.col("s") * F.col("suu") - F.col("su") * F.col("su")
    slope = F.try_divide(F.col("s") * F.col("suv") - F.col("su") * F.col("sv"), spread)
    lines = sums.select(
        slope.alias("slope"), ((F.col("sv") - slope * F.col("su")) / F.col("s")).alias("height")
    ).where(F.col("slope").isNotNull())
    at = _grid_x(F.col("position"), low, high, grid)
    tail = (1.0 - level) / 2.0
    # replicates x grid rows from here on, whatever the size of the table.
    return (
        lines.withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
        .withColumn("line", mean_y + F.col("height") + F.col("slope") * (at - mean_x))
        .groupBy("position")
        .agg(F.percentile("line", [tail, 1.0 - tail]).alias("ends"))
        .select("position", at.alias("x"), F.col("ends")[0].alias("low"), F.col("ends")[1].alias("high"))
    )
