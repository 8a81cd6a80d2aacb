"""Chart data for distributions: equal-width histograms and Gaussian density curves."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .describe import finite

BINS = 100
GRID = 200
# Values are put together in cells of this part of a bandwidth, with their moments about the middle of the cell up to
# ORDER. A kernel's series around the middle then stops at a term of (z / 256)^7 / 7! of its height, z bandwidths away:
# 4e-10 at the end of its reach, below 1e-13 within ten bandwidths, for any number and any spread of values.
CELLS_IN_BANDWIDTH, ORDER = 128, 6
# exp(-z*z/2) is zero in double precision beyond this distance.
KERNEL_REACH = 38.7


@dataclass(frozen=True)
class Spread:
    """What a histogram or density needs to know about a column beforehand."""

    column: str
    n: int
    low: float | None
    high: float | None
    std: float

    def edges(self) -> tuple[float | None, float | None]:
        """Histogram range; a constant column gets a unit range around its value, an empty one none."""
        if self.low is None:
            return None, None
        if self.low == self.high:
            return self.low - 0.5, self.high + 0.5
        return self.low, self.high

    def bandwidth(self) -> float:
        """Scott's rule for one dimension."""
        return self.std * self.n ** (-1.0 / 5.0)


def spreads(df: DataFrame, columns: Sequence[str]) -> list[Spread]:
    """Count, range and deviation of every column in one aggregate; a column without values has a count of 0."""
    values = finite(df, columns)
    row = values.agg(
        *[
            F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.stddev_samp(c).alias("sd")).alias(f"s{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    return [
        Spread(c, row[i]["n"], row[i]["lo"], row[i]["hi"], row[i]["sd"] or 0.0)
        for i, c in enumerate(columns)
    ]


def _long(df: DataFrame, found: Sequence[Spread], *parameters: tuple[str, list]) -> DataFrame:
    """``(variable, value, parameters...)`` rows; the parameters are literals per variable."""
    structs = [
        F.struct(
            F.lit(s.column).alias("variable"),
            F.col(f"`{s.column}`").alias("value"),
            *[F.lit(values[i]).cast("double").alias(name) for name, values in parameters],
        )
        for i, s in enumerate(found)
    ]
    rows = finite(df, [s.column for s in found]).select(F.inline(F.array(*structs)))
    return rows.where(F.col("value").isNotNull())


def _axis(spark: SparkSession, found: Sequence[Spread], size: int, *parameters: tuple[str, list]) -> DataFrame:
    """Every position 0..size-1 for every variable, with the variable's parameters."""
    structs = [
        F.struct(F.lit(s.column).alias("variable"), *[F.lit(values[i]).cast("double").alias(name) for name, values in parameters])
        for i, s in enumerate(found)
    ]
    positions = spark.range(size).select(F.col("id").cast("int").alias("position"))
    return positions.select("position", F.inline(F.array(*structs)))


def histogram(
    df: DataFrame, columns: Sequence[str], bins: int = BINS, found: Sequence[Spread] | None = None
) -> DataFrame:
    """``(variable, bin, low, high, rows)`` for every bin, empty ones included.

    Bins are closed on the left and the last one on both sides. A column without values
    has bins without edges. One scan, and a
    shuffle of at most ``bins`` rows per variable and task.
    """
    spark = df.sparkSession
    found = list(spreads(df, columns) if found is None else found)
    if not found:
        return spark.createDataFrame([], "variable string, bin int, low double, high double, rows bigint")
    lows = [s.edges()[0] for s in found]
    steps = [None if s.low is None else (s.edges()[1] - s.edges()[0]) / bins for s in found]
    parameters = (("lo", lows), ("step", steps))
    counts = (
        _long(df, found, *parameters)
        .select("variable", _bin(bins).alias("position"))
        .groupBy("variable", "position")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    axis = _axis(spark, found, bins, *parameters, ("hi", [s.edges()[1] for s in found]))
    # ``counts`` has at most bins x variables rows, so it may be broadcast.
    return axis.join(F.broadcast(counts), ["variable", "position"], "left").select(
        "variable",
        F.col("position").alias("bin"),
        (F.col("lo") + F.col("position") * F.col("step")).alias("low"),
        F.when(F.col("position") == bins - 1, F.col("hi"))
        .otherwise(F.col("lo") + (F.col("position") + 1) * F.col("step"))
        .alias("high"),
        F.coalesce("rows", F.lit(0)).alias("rows"),
    )


def _bin(bins: int) -> Column:
    """Bin of ``value``: by division, then set right against the bin's own edges."""
    guess = F.least(F.lit(bins - 1), F.floor((F.col("value") - F.col("lo")) / F.col("step")).cast("int"))
    lower = F.col("lo") + guess * F.col("step")
    upper = F.col("lo") + (guess + 1) * F.col("step")
    return (
        F.when(F.col("value") < lower, guess - 1)
        .when((F.col("value") >= upper) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )


def _power(value: Column, k: int) -> Column:
    out = F.lit(1.0)
    for _ in range(k):
        out = out * value
    return out


def _series(z: Column) -> Column:
    """The kernels of a cell's values over the kernel of its middle: Hermite polynomials times moments."""
    before, now = F.lit(0.0), F.lit(1.0)
    total, factorial = F.col("m0"), 1.0
    for k in range(1, ORDER + 1):
        before, now = now, z * now - F.lit(float(k - 1)) * before
        factorial *= k
        total = total + now * F.col(f"m{k}") / F.lit(factorial)
    return total


def density(
    df: DataFrame,
    columns: Sequence[str],
    bins: int = BINS,
    grid: int = GRID,
    found: Sequence[Spread] | None = None,
) -> DataFrame:
    """``(variable, position, x, y)``: a Gaussian kernel density on the histogram's count scale.

    One scan sums the values' moments by cells of a part of the bandwidth; what follows is occupied cells times the
    grid points that their kernels reach: a kernel is exactly zero in double precision outside. The curve is that of the
    single values to 4e-10 of every kernel's height. Columns without spread have rows with a null height.
    """
    spark = df.sparkSession
    every = list(spreads(df, columns) if found is None else found)
    found = [s for s in every if s.std > 0]
    flat = [c for c in columns if c not in {s.column for s in found}]
    empty = spark.createDataFrame([(c,) for c in flat], "variable string").select("variable", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("position"))
    empty = empty.select("variable", "position", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    if not found:
        return empty
    parameters = (
        ("lo", [s.low for s in found]),
        ("reach", [s.high - s.low for s in found]),
        ("h", [s.bandwidth() for s in found]),
    )
    point = F.col("lo") + F.col("reach") * F.col("position") / F.lit(grid - 1)
    step = F.col("reach") / F.lit(grid - 1)
    away = F.lit(KERNEL_REACH) * F.col("h")
    first = F.greatest(F.lit(0.0), F.floor((F.col("middle") - away - F.col("lo")) / step).cast("double"))
    last = F.least(F.lit(grid - 1.0), F.ceil((F.col("middle") + away - F.col("lo")) / step).cast("double"))
    width = F.col("h") / F.lit(float(CELLS_IN_BANDWIDTH))
    cell = F.rint((F.col("value") - F.col("lo")) / width)
    placed = _long(df, found, *parameters).withColumn("middle", F.col("lo") + cell * width)
    u = (F.col("value") - F.col("middle")) / F.col("h")
    cells = placed.groupBy("variable", "lo", "reach", "h", "middle").agg(*(F.sum(_power(u, k)).alias(f"m{k}") for k in range(ORDER + 1)))
    z = (point - F.col("middle")) / F.col("h")
    spread_out = cells.withColumn("position", F.explode(F.sequence(first.cast("int"), last.cast("int")))).withColumn("z", z)
    sums = spread_out.groupBy("variable", "position").agg(F.sum(_series(F.col("z")) * F.exp(F.lit(-0.5) * F.col("z") * F.col("z"))).alias("mass"))
    axis = _axis(spark, found, grid, *parameters)
    scale = F.col("reach") / F.lit(float(bins)) / (F.col("h") * F.sqrt(F.lit(2.0) * F.pi()))
    # ``sums`` has at most grid x variables rows, so it may be broadcast.
    return axis.join(F.broadcast(sums), ["variable", "position"], "left").select(
        "variable",
        "position",
        point.alias("x"),
        (F.coalesce("mass", F.lit(0.0)) * scale).alias("y"),
    ).unionByName(empty)
