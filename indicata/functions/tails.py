"""Tail probabilities for a handful of result rows (no SciPy in the runtime).

Regularised incomplete beta by the Lentz continued fraction. These are plain
functions because they only ever see one value per regression term. Both x and
1 - x are passed around and log-gamma differences use Stirling's series, so the
result holds when the degrees of freedom run into the billions.
"""

from __future__ import annotations

import math

_TINY = 1e-300
_STIRLING_FROM = 1e4


def _log_gamma_step(a: float, b: float) -> float:
    """log Gamma(a + b) - log Gamma(a), without cancellation for large ``a``."""
    if a < _STIRLING_FROM:
        return math.lgamma(a + b) - math.lgamma(a)
    series = 1.0 / (12.0 * (a + b)) - 1.0 / (12.0 * a)
    return (a + b - 0.5) * math.log1p(b / a) + b * math.log(a) - b + series


def _log_beta(a: float, b: float) -> float:
    small, large = sorted((a, b))
    return math.lgamma(small) - _log_gamma_step(large, small)


def _clear_of_zero(v: float) -> float:
    return v if abs(v) > _TINY else _TINY


def incomplete_beta(a: float, b: float, x: float, y: float) -> float:
    """Regularised incomplete beta function I_x(a, b); ``y`` is 1 - x."""
    if x <= 0.0 or y <= 0.0:
        return 0.0 if x <= 0.0 else 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - incomplete_beta(b, a, y, x)
    log_x = math.log1p(-y) if y < 0.5 else math.log(x)
    log_y = math.log1p(-x) if x < 0.5 else math.log(y)
    front = math.exp(a * log_x + b * log_y - _log_beta(a, b)) / a
    c = 1.0
    d = 1.0 / _clear_of_zero(1.0 - (a + b) * x / (a + 1.0))
    fraction = d
    for m in range(1, 2_000_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        before = fraction
        for term in (even, odd):
            d = 1.0 / _clear_of_zero(1.0 + term * d)
            c = _clear_of_zero(1.0 + term / c)
            fraction *= c * d
        if abs(fraction - before) <= 1e-15 * abs(fraction):
            return front * fraction
    raise ArithmeticError(f"incomplete beta of ({a}, {b}) at {x} does not converge")


def student_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|) for Student's t."""
    return f_upper(t * t, 1.0, df)


def student_quantile(df: float, two_sided: float = 0.05) -> float:
    """The t with P(|T| > t) = ``two_sided``, by bisection."""
    low, high = 0.0, 1.0
    while student_two_sided(high, df) > two_sided:
        high *= 2.0
    while True:
        middle = (low + high) / 2.0
        if middle in (low, high):
            return middle
        if student_two_sided(middle, df) > two_sided:
            low = middle
        else:
            high = middle


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F > f) for the F distribution."""
    if math.isnan(f):
        return math.nan
    if math.isinf(f):
        return 0.0
    whole = df2 + df1 * f
    return incomplete_beta(df2 / 2.0, df1 / 2.0, df2 / whole, df1 * f / whole)


def chi2_upper_two_df(x: float) -> float:
    """P(X > x) for chi-squared with two degrees of freedom."""
    return math.exp(-x / 2.0)
