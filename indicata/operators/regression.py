"""Ordinary least squares with intercept from one pass of centred statistics.

The data are read once: a single aggregate returns count, means and centred
cross-products, and everything about the fit that does not need residuals -
coefficients, errors, quality, type-II analysis of variance, condition number -
follows from that (k+1) x (k+1) table. The predictors are scaled to unit spread
before solving, so columns of very different size do not cost digits.

Constant or collinear predictors leave the coefficients open. An eigen-decomposition of
the scaled cross-products finds the rank and the directions that change no fitted value;
of all solutions the one of least length is taken, in the columns' own units and the
intercept included, and its errors are those of the pseudo-inverse. Fitted values,
residuals and quality are then those of the model without the superfluous columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicata.functions import finite_or_null
from indicata.functions.tails import f_upper, student_quantile, student_two_sided

from .correlation import FEW_COLUMNS
from .moments import cross_moments

INTERCEPT = "Intercept"
COLLINEAR_BELOW = 1e-12
#: Shares of a column, and remainders of its mean, that are no more than rounding.
ROUNDING = 1e-11


class NotEstimable(ValueError):
    """Too few complete rows."""


def complete_case(columns: Sequence[str]) -> Column:
    """True where every column is present and finite (listwise deletion)."""
    test = F.lit(True)
    for c in columns:
        test = test & finite_or_null(F.col(f"`{c}`").cast("double")).isNotNull()
    return test


def statistics_columns(columns: Sequence[str]) -> list[Column]:
    """The aggregates the fit needs, over complete cases only."""
    case = complete_case(columns)
    value = {c: F.when(case, F.col(f"`{c}`").cast("double")) for c in columns}
    out = [F.count_if(case).alias("n")]
    out += [F.avg(value[c]).alias(f"mean_{i}") for i, c in enumerate(columns)]
    out += [
        F.covar_pop(value[columns[i]], value[columns[j]]).alias(f"cov_{i}_{j}")
        for i, j in combinations_with_replacement(range(len(columns)), 2)
    ]
    return out


@dataclass(frozen=True)
class Fit:
    """A fitted model; all fields come from the centred statistics. Terms stand with the intercept first."""

    response: str
    predictors: tuple[str, ...]
    n: int
    rank: int  # of the design matrix, intercept included
    means: np.ndarray  # response first
    cross: np.ndarray  # centred cross-products, response first
    slopes: np.ndarray
    intercept: float
    inverse: np.ndarray  # of the Gram matrix of the design; the pseudo-inverse where it has none
    fitted_square: float  # of the centred fitted values

    @property
    def df_residual(self) -> int:
        return self.n - self.rank

    @property
    def df_model(self) -> int:
        return self.rank - 1

    @property
    def total(self) -> float:
        return float(self.cross[0, 0])

    @property
    def explained(self) -> float:
        return self.fitted_square

    @property
    def residual(self) -> float:
        return max(self.total - self.explained, 0.0)

    @property
    def mse(self) -> float:
        return self.residual / self.df_residual

    def residual_column(self) -> Column:
        """Observed minus fitted, null outside complete cases."""
        fitted = F.lit(float(self.intercept))
        for name, slope in zip(self.predictors, self.slopes):
            fitted = fitted + F.lit(float(slope)) * F.col(f"`{name}`").cast("double")
        case = complete_case([self.response, *self.predictors])
        return F.when(case, F.col(f"`{self.response}`").cast("double") - fitted)

    def coefficients(self) -> list[tuple]:
        """``(term, coef, std_err, t, p_value, low, high)`` per term, intercept first; t and p are null for 0 over 0."""
        margin = student_quantile(self.df_residual)
        terms, rows = (INTERCEPT, *self.predictors), []
        for coef, variance in zip((self.intercept, *self.slopes), np.diag(self.inverse)):
            error = math.sqrt(self.mse * max(variance, 0.0))
            t = coef / error if error > 0 else math.copysign(math.inf, coef) if coef else None
            p = None if t is None else float(student_two_sided(t, self.df_residual))
            rows.append((float(coef), error, None if t is None else float(t), p, float(coef - margin * error), float(coef + margin * error)))
        return [(term, *row) for term, row in zip(terms, rows)]

    def quality(self) -> dict[str, float | None]:
        """Degrees of freedom go by the rank. What a constant response or a model without slopes leaves undefined is None."""
        n, k, d = self.n, self.df_model, self.df_residual
        f = None if k == 0 or self.total == 0 else self.explained / k / self.mse if self.mse > 0 else math.inf
        r2 = 1.0 - self.residual / self.total if self.total > 0 else None
        perfect = self.residual <= 0
        log_lik = math.inf if perfect else -n / 2.0 * (math.log(2.0 * math.pi) + math.log(self.residual / n) + 1.0)
        return {
            "n": float(n),
            "df_model": float(k),
            "df_residual": float(d),
            "r2": r2,
            "adj_r2": None if r2 is None else 1.0 - (1.0 - r2) * (n - 1) / d,
            "f": f,
            "f_p_value": None if f is None else f_upper(f, k, d),
            "log_likelihood": log_lik,
            "aic": -2.0 * log_lik + 2.0 * (k + 1),
            "bic": -2.0 * log_lik + (k + 1) * math.log(n),
        }

    def anova(self) -> list[tuple]:
        """Type II: ``(term, sum_sq, df, f, p_value)`` per predictor and the residual row.

        A term's sum of squares is what the residual grows by if its coefficient is held at zero, b^2 / (G^-1)_jj:
        no difference of large numbers. Of predictors that say the same, each has the sum of all of them; a
        coefficient that is zero in every solution has none.
        """
        rows = []
        for j, term in enumerate(self.predictors, 1):
            variance, slope = self.inverse[j, j], self.slopes[j - 1]
            if variance <= 0:
                rows.append((term, None, 1.0, None, None))
                continue
            sum_sq = float(slope**2 / variance)
            f = sum_sq / self.mse if self.mse > 0 else math.inf if sum_sq > 0 else None
            rows.append((term, sum_sq, 1.0, f, None if f is None else f_upper(f, 1.0, self.df_residual)))
        rows.append(("Residual", self.residual, float(self.df_residual), None, None))
        return rows

    def condition_number(self) -> float:
        """Largest over smallest singular value of the design matrix, intercept included; infinite if columns are superfluous.

        Both ends are largest eigenvalues - of the Gram matrix and of its inverse -
        because the smallest one drowns in rounding when columns differ in size.
        """
        if self.rank <= len(self.predictors):
            return math.inf
        mean, k = self.means[1:], len(self.predictors)
        gram = np.empty((k + 1, k + 1))
        gram[0, 0], gram[0, 1:], gram[1:, 0] = self.n, self.n * mean, self.n * mean
        gram[1:, 1:] = self.cross[1:, 1:] + self.n * np.outer(mean, mean)
        return float(math.sqrt(np.linalg.eigvalsh(gram)[-1] * np.linalg.eigvalsh(self.inverse)[-1]))


def fit_from_statistics(row, response: str, predictors: Sequence[str]) -> Fit:
    """Solve for the coefficients from one row of ``statistics_columns``."""
    k, n = len(predictors), int(row["n"])
    means = np.array([row[f"mean_{i}"] if n else 0.0 for i in range(k + 1)])
    cross = np.empty((k + 1, k + 1))
    for i, j in combinations_with_replacement(range(k + 1), 2):
        cross[i, j] = cross[j, i] = n * row[f"cov_{i}_{j}"] if n else 0.0
    return fit_from_moments(n, means, cross, response, predictors)


def fit_from_moments(n: int, means: np.ndarray, cross: np.ndarray, response: str, predictors: Sequence[str]) -> Fit:
    """The fit from the number of complete rows, the means and the centred cross-products, response first."""
    spread = np.sqrt(np.diag(cross))[1:]
    varied = spread > 0
    unit = np.where(varied, spread, 1.0)
    scaled = cross[1:, 1:] / np.outer(unit, unit)
    values, vectors = np.linalg.eigh(scaled) if len(unit) else (np.zeros(0), np.zeros((0, 0)))
    held = values > COLLINEAR_BELOW
    rank = 1 + int(held.sum())
    if n <= rank:
        raise NotEstimable(f"{n} complete rows for {rank} coefficients")
    if held.all():
        within = np.linalg.inv(scaled) if len(unit) else scaled
    else:
        within = vectors[:, held] / values[held] @ vectors[:, held].T
    towards = cross[1:, 0] / unit
    slopes = within @ towards / unit
    fitted = float(towards @ within @ towards)
    inverse = _whole(within / np.outer(unit, unit), means[1:], n)
    terms = np.array([means[0] - slopes @ means[1:], *slopes])
    if not held.all():
        row_space = _row_space(scaled, unit, means[1:], rank - 1)
        terms, inverse = row_space @ terms, row_space @ inverse @ row_space
    return Fit(response, tuple(predictors), n, rank, means, cross, terms[1:], float(terms[0]), inverse, fitted)


def _whole(within: np.ndarray, mean: np.ndarray, n: int) -> np.ndarray:
    """The (generalised) inverse of the Gram matrix of the design, from that of the centred cross-products."""
    shift = within @ mean
    corner = np.array([[1.0 / n + mean @ shift]])
    return np.block([[corner, -shift[None, :]], [-shift[:, None], within]])


def _row_space(scaled: np.ndarray, unit: np.ndarray, mean: np.ndarray, rank: int) -> np.ndarray:
    """Projection that takes out the combinations of terms that are zero in every row of the design.

    ``rank`` columns are picked that leave the least of the others unexplained; each other column is a combination of
    these and the intercept. Shares and remainders that are rounding alone are zero, or else columns far from zero would
    mix with the intercept.
    """
    left, picked = scaled.copy(), []
    for _ in range(rank):
        best = int(np.argmax(np.where(np.isin(np.arange(len(unit)), picked), -1.0, np.diag(left))))
        picked.append(best)
        left = left - np.outer(left[:, best], left[best]) / left[best, best]
    null = []
    for j in sorted(set(range(len(unit))) - set(picked)):
        share = np.linalg.solve(scaled[np.ix_(picked, picked)], scaled[picked, j])
        share = np.where(np.abs(share) < ROUNDING, 0.0, share) * unit[j] / unit[picked]
        rest = mean[j] - share @ mean[picked]
        if abs(rest) <= ROUNDING * (abs(mean[j]) + np.abs(share * mean[picked]).sum()) and np.any(share):
            rest = 0.0
        column = np.zeros(len(unit) + 1)
        column[0], column[1 + j], column[1 + np.array(picked, dtype=int)] = rest, -1.0, share
        for _ in range(2):  # step by step, as zeros stay zeros in this way
            for other in null:
                column = column - (other @ column) * other
        null.append(column / np.linalg.norm(column))
    return np.eye(len(unit) + 1) - sum(np.outer(v, v) for v in null)


def ols(df: DataFrame, response: str, predictors: Sequence[str]) -> Fit:
    """Fit ``response ~ 1 + predictors`` over complete cases, reading ``df`` once."""
    columns = [response, *predictors]
    if len(columns) <= FEW_COLUMNS:
        return fit_from_statistics(df.agg(*statistics_columns(columns)).first(), response, predictors)
    moments = cross_moments(df.where(complete_case(columns)), columns)
    return fit_from_moments(int(moments.rows[0, 0]), np.diag(moments.mean).copy(), moments.products, response, predictors)


COEFFICIENT_SCHEMA = (
    "term string, coef double, std_err double, t double, p_value double, low double, high double"
)
ANOVA_SCHEMA = "term string, sum_sq double, df double, f double, p_value double"


def coefficient_table(spark: SparkSession, fit: Fit) -> DataFrame:
    return spark.createDataFrame(fit.coefficients(), COEFFICIENT_SCHEMA)


def quality_table(spark: SparkSession, fit: Fit) -> DataFrame:
    return spark.createDataFrame(list(fit.quality().items()), "stat string, value double")


def anova_table(spark: SparkSession, fit: Fit) -> DataFrame:
    return spark.createDataFrame(fit.anova(), ANOVA_SCHEMA)
