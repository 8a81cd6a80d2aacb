"""Chart data: histograms with density curves, scatter, trend line with band, heat map."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import names
from indicata.operators.correlation import correlation_matrix
from indicata.operators.distribution import density, histogram, spreads
from indicata.operators.quantiles import exact_quantiles
from indicata.operators.trend import points, sampled_points, trend_band, trend_line

from .analysis import CORRELATED

CHARTED = (names.INDEX, names.REVENUE, names.GDP, names.BURDEN)
TRIMMED = (names.REVENUE, names.GDP)
TRIM_AT = 0.95


def trimmed(gold: DataFrame, columns=TRIMMED, fraction: float = TRIM_AT) -> DataFrame:
    """The table with each listed column null above its own quantile; other columns as they are."""
    bounds = exact_quantiles(gold, {c: [fraction] for c in columns})
    return gold.withColumns(
        {c: F.when(F.col(c) <= F.lit(bounds[c][fraction]), F.col(c)) for c in columns}
    )


def chart_data(gold: DataFrame, x: str = names.BURDEN, y: str = names.INDEX, key: str = names.CODE, scatter: int | None = None) -> DataFrame:
    """One long table ``chart, series, x, y``. ``gold`` should be stored.

    The scatter holds every point, or a sample of ``scatter`` points that is the same in every run.
    """
    cut = trimmed(gold)
    found = spreads(cut, CHARTED)

    def shaped(df: DataFrame, chart: str, series, at, value) -> DataFrame:
        return df.select(
            F.lit(chart).alias("chart"),
            series.alias("series"),
            at.cast("double").alias("x"),
            value.cast("double").alias("y"),
        )

    pair = F.lit(f"{y}~{x}")
    band = trend_band(gold, x, y, key)
    matrix = correlation_matrix(gold, CORRELATED)
    parts = [
        shaped(histogram(cut, CHARTED, found=found), "histogram", F.col("variable"), F.col("low"), F.col("rows")),
        shaped(density(cut, CHARTED, found=found), "density", F.col("variable"), F.col("x"), F.col("y")),
        shaped(points(gold, x, y) if scatter is None else sampled_points(gold, x, y, key, scatter), "scatter", pair, F.col("x"), F.col("y")),
        shaped(trend_line(gold, x, y), "trend", pair, F.col("x"), F.col("y")),
        shaped(band, "band_low", pair, F.col("x"), F.col("low")),
        shaped(band, "band_high", pair, F.col("x"), F.col("high")),
        shaped(matrix, "heatmap", F.concat_ws("|", "var_x", "var_y"), F.lit(None), F.col("r")),
    ]
    return reduce(DataFrame.unionByName, parts)
