"""Diagnostics that need a second look at the data: moments and serial correlation of residuals."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicata.functions.tails import chi2_upper_two_df

from .regression import Fit
from .rows import sort_columns


def diagnostics(df: DataFrame, fit: Fit) -> dict[str, float | None]:
    """Skewness, kurtosis, Jarque-Bera and omnibus of the residuals, from one aggregate; None where undefined."""
    e = fit.residual_column()
    skew, excess = df.agg(F.skewness(e), F.kurtosis(e)).first()
    names = ("skewness", "kurtosis", "jarque_bera", "jarque_bera_p", "omnibus", "omnibus_p")
    if skew is None:  # a perfect fit has no residuals to speak of
        return dict.fromkeys(names)
    n, kurtosis = fit.n, excess + 3.0
    jarque_bera = n / 6.0 * (skew**2 + excess**2 / 4.0)
    out = dict.fromkeys(names) | {
        "skewness": skew,
        "kurtosis": kurtosis,
        "jarque_bera": jarque_bera,
        "jarque_bera_p": chi2_upper_two_df(jarque_bera),
    }
    if n >= 8:  # below that the normal approximations are undefined
        omnibus = _skew_score(skew, n) ** 2 + _kurtosis_score(kurtosis, n) ** 2
        out |= {"omnibus": omnibus, "omnibus_p": chi2_upper_two_df(omnibus)}
    return out


def _skew_score(skew: float, n: int) -> float:
    """D'Agostino's normal score of a sample skewness."""
    y = skew * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2.0 * (beta - 1.0)) - 1.0
    return math.asinh(y / math.sqrt(2.0 / (w2 - 1.0))) / math.sqrt(0.5 * math.log(w2))


def _kurtosis_score(kurtosis: float, n: int) -> float:
    """Anscombe and Glynn's normal score of a sample kurtosis."""
    expected = 3.0 * (n - 1) / (n + 1)
    variance = 24.0 * n * (n - 2) * (n - 3) / ((n + 1.0) ** 2 * (n + 3) * (n + 5))
    x = (kurtosis - expected) / math.sqrt(variance)
    q = 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3)))
    a = 6.0 + 8.0 / q * (2.0 / q + math.sqrt(1.0 + 4.0 / q**2))
    u = 1.0 + x * math.sqrt(2.0 / (a - 4.0))
    root = math.copysign(((1.0 - 2.0 / a) / abs(u)) ** (1.0 / 3.0), u)
    return (1.0 - 2.0 / (9.0 * a) - root) / math.sqrt(2.0 / (9.0 * a))


def durbin_watson(df: DataFrame, fit: Fit, key: str) -> DataFrame:
    """Sum of squared steps between neighbouring residuals over their sum of squares.

    Neighbours are taken in key order. A window over the whole table would sort
    it in one task, so the rows are range-partitioned and sorted within
    partitions; each partition reports its sums and its two border residuals and
    the steps across borders are added from those, one row per partition.

    The row position breaks the last ties, so a long run of equal rows can be cut
    by the range partitioner as well. It is stable under recomputation for a
    stored table, which is what ``df`` should be.
    """
    e = fit.residual_column()
    position = F.monotonically_increasing_id()
    rows = df.select(key, e.alias("_e"), position.alias("_position")).where(F.col("_e").isNotNull())
    order = sort_columns(rows, key)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("_e")
    parts = ordered.mapInArrow(_partial_sums, "part int, squares double, steps double, first_e double, last_e double")
    # As many rows as there are partitions, so one task can hold them.
    border = F.col("first_e") - F.lag("last_e").over(Window.orderBy("part"))
    joined = parts.withColumn("across", F.coalesce(border * border, F.lit(0.0)))
    ratio = (F.sum("steps") + F.sum("across")) / F.sum("squares")
    return joined.agg(F.when(F.sum("squares") > 0, ratio).alias("durbin_watson"))


def _partial_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squares = steps = 0.0
    first = last = None
    for batch in batches:
        e = batch.column(0).to_numpy(zero_copy_only=False)
        if e.size == 0:
            continue
        if first is None:
            first = float(e[0])
        else:
            steps += (float(e[0]) - last) ** 2
        squares += float(e @ e)
        difference = np.diff(e)
        steps += float(difference @ difference)
        last = float(e[-1])
    if first is not None:
        row = {
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()),
            "squares": [squares],
            "steps": [steps],
            "first_e": [first],
            "last_e": [last],
        }
        yield pa.RecordBatch.from_pydict(row)
