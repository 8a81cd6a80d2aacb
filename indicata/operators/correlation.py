"""Pearson correlation, pairwise complete, over finite values."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicata.functions import finite_or_null

from .moments import cross_moments

#: Columns whose pairs are aggregates of one query; more go through matrices.
FEW_COLUMNS = 12


def pair_structs(columns: Sequence[str]) -> Column:
    """Every unordered pair as an array of ``(var_x, var_y, r, pairs)`` aggregates.

    A pair without spread in either member has no coefficient.
    """
    structs = []
    for x, y in combinations_with_replacement(columns, 2):
        a, b = (finite_or_null(F.col(f"`{c}`").cast("double")) for c in (x, y))
        both = a.isNotNull() & b.isNotNull()
        a, b = F.when(both, a), F.when(both, b)
        # Not ``corr``, which fails on a constant column in ANSI mode.
        r = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
        structs.append(
            F.struct(
                F.lit(x).alias("var_x"),
                F.lit(y).alias("var_y"),
                (F.when(r.isNotNull(), 1.0) if x == y else F.when(r.isNotNull(), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r)))).alias("r"),
                F.count_if(both).alias("pairs"),
            )
        )
    return F.array(*structs)


def mirrored(pairs: DataFrame) -> DataFrame:
    """The full symmetric matrix in long form from its upper triangle."""
    both = F.array(
        F.struct("var_x", "var_y", "r", "pairs"),
        F.struct(F.col("var_y").alias("var_x"), F.col("var_x").alias("var_y"), "r", "pairs"),
    )
    own = F.slice(both, 1, F.when(F.col("var_x") == F.col("var_y"), 1).otherwise(2))
    return pairs.select(F.inline(own))


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per unordered pair (a variable with itself included), one scan in all.

    A few columns are a few aggregates; of many, blocks of cross-products are added up.
    """
    if len(columns) <= FEW_COLUMNS:
        return df.agg(pair_structs(columns).alias("p")).select(F.inline("p"))
    moments = cross_moments(df, columns)
    r = moments.correlation()
    pairs = [(columns[i], columns[j], None if np.isnan(r[i, j]) else float(r[i, j]), int(moments.rows[i, j])) for i, j in combinations_with_replacement(range(len(columns)), 2)]
    return df.sparkSession.createDataFrame(pairs, "var_x string, var_y string, r double, pairs bigint")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return mirrored(correlation_pairs(df, columns))
