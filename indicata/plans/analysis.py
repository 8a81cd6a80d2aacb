"""Analysis of the gold table: correlation matrix, regression, analysis of variance."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicata import names
from indicata.operators.correlation import mirrored, pair_structs
from indicata.operators.regression import (
    Fit,
    anova_table,
    coefficient_table,
    fit_from_statistics,
    statistics_columns,
)
from indicata.operators.residuals import diagnostics, durbin_watson

RESPONSE = names.INDEX
PREDICTORS = (names.BURDEN, names.GDP)
CORRELATED = (names.INDEX, names.BURDEN, names.GDP)


@dataclass(frozen=True)
class Report:
    """The three result tables, and the fit they came from."""

    correlation: DataFrame
    anova: DataFrame
    model: DataFrame
    fit: Fit

    def tables(self) -> dict[str, DataFrame]:
        return {
            "report_correlation": self.correlation,
            "report_anova": self.anova,
            "report_model": self.model,
        }

    def long(self) -> DataFrame:
        """All three as ``report, item, stat, value``."""
        correlation = self.correlation.select(
            F.lit("correlation").alias("report"),
            F.concat_ws("|", "var_x", "var_y").alias("item"),
            F.lit("r").alias("stat"),
            F.col("r").alias("value"),
        )
        anova = self.anova.unpivot(["term"], ["sum_sq", "df", "f", "p_value"], "stat", "value")
        anova = anova.select(F.lit("anova").alias("report"), F.col("term").alias("item"), "stat", "value")
        model = self.model.select(F.lit("model").alias("report"), "item", "stat", "value")
        return correlation.unionByName(anova).unionByName(model)


def model_table(gold: DataFrame, fit: Fit, key: str = names.CODE) -> DataFrame:
    """Coefficients, quality and residual diagnostics as ``item, stat, value``."""
    spark = gold.sparkSession
    terms = coefficient_table(spark, fit).unpivot(
        ["term"], ["coef", "std_err", "t", "p_value", "low", "high"], "stat", "value"
    )
    terms = terms.withColumnRenamed("term", "item")
    whole = {**fit.quality(), **diagnostics(gold, fit), "condition_number": fit.condition_number()}
    model = spark.createDataFrame([("model", s, None if v is None else float(v)) for s, v in whole.items()], "item string, stat string, value double")
    serial = durbin_watson(gold, fit, key).select(
        F.lit("model").alias("item"), F.lit("durbin_watson").alias("stat"), F.col("durbin_watson").alias("value")
    )
    return terms.unionByName(model).unionByName(serial)


def analyze(
    gold: DataFrame,
    response: str = RESPONSE,
    predictors: Sequence[str] = PREDICTORS,
    correlated: Sequence[str] = CORRELATED,
    key: str = names.CODE,
) -> Report:
    """Everything the report shows.

    One scan yields the matrix, the fit and the analysis of variance together;
    the residuals take one more scan, and their serial correlation a range sort.
    ``gold`` should be a stored table.
    """
    row = gold.agg(pair_structs(correlated).alias("pairs"), *statistics_columns([response, *predictors])).first()
    fit = fit_from_statistics(row, response, predictors)
    spark = gold.sparkSession
    pairs = spark.createDataFrame(row["pairs"], "var_x string, var_y string, r double, pairs bigint")
    return Report(mirrored(pairs), anova_table(spark, fit), model_table(gold, fit, key), fit)
