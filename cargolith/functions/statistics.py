"""Tail probabilities and the normal quantile as plain column expressions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Chebyshev coefficients for the complementary error function
# (fractional error below 1.2e-7 everywhere), constant term first.
ERFC_COEFFICIENTS = [
    -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
]


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows with both values; NULL when either side is constant
    (the built-in ``corr`` raises a division error there in ANSI mode)."""
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a.cast("double")), F.when(both, b.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def erfc_positive(x: Column) -> Column:
    """erfc(x) for x >= 0."""
    t = 1 / (1 + x * 0.5)
    poly = F.lit(ERFC_COEFFICIENTS[-1])
    for c in reversed(ERFC_COEFFICIENTS[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


def two_sided_normal(z: Column) -> Column:
    """P(|Z| > |z|)."""
    return erfc_positive(F.abs(z) / math.sqrt(2))


def kolmogorov_tail(x: Column, terms: int = 100) -> Column:
    """Limit distribution of the two-sample distance."""
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * x * x),
    )
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))


def chi2_two_tail(x: Column) -> Column:
    """Upper tail of chi-squared with two degrees of freedom."""
    return F.exp(-x / 2)


def skew_z(g1: Column, n: Column) -> Column:
    """Normal score of the sample skewness (D'Agostino)."""
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + F.sqrt(2 * (beta - 1))
    delta = 1 / F.sqrt(0.5 * F.log(w2))
    alpha = F.sqrt(2.0 / (w2 - 1))
    q = y / alpha
    return delta * F.log(q + F.sqrt(q * q + 1))


def kurtosis_z(g2: Column, n: Column) -> Column:
    """Normal score of the sample kurtosis, ``g2`` being the excess (Anscombe and Glynn)."""
    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - mean) / F.sqrt(var)
    root = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / root * (2.0 / root + F.sqrt(1 + 4.0 / (root * root)))
    inner = (1 - 2.0 / a) / (1 + x * F.sqrt(2.0 / (a - 4)))
    return ((1 - 2.0 / (9.0 * a)) - F.signum(inner) * F.pow(F.abs(inner), 1 / 3)) / F.sqrt(2.0 / (9.0 * a))


def _beta_fraction(a: np.ndarray, b: float, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (Lentz), vectorised."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1 - (a + b) * x / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 300):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
    return h


def student_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(|T| > |t|) of Student's distribution."""
    t, df = np.asarray(t, float), np.asarray(df, float)
    x = df / (df + t * t)
    a, b = df / 2, 0.5
    log_front = np.array([math.lgamma(p + b) - math.lgamma(p) - math.lgamma(b) for p in a])
    with np.errstate(divide="ignore", invalid="ignore"):
        front = np.exp(log_front + a * np.log(x) + b * np.log1p(-x))
        direct = front * _beta_fraction(a, b, x) / a
        swapped = 1 - front * _beta_fraction(np.full_like(a, b), a, 1 - x) / b
    return np.clip(np.where(x < (a + 1) / (a + b + 2), direct, np.where(t == 0, 1.0, swapped)), 0, 1)


def _log_gamma_step(a: Column) -> Column:
    """ln Gamma(a + 1/2) - ln Gamma(a): twenty steps up by the recurrence, then the asymptotic series."""
    up = a + 20
    series = 1 - 1 / (8 * up) + 1 / (128 * up * up) + 5 / (1024 * F.pow(up, 3)) - 21 / (32768 * F.pow(up, 4)) - 399 / (262144 * F.pow(up, 5))
    down = F.aggregate(F.sequence(F.lit(0), F.lit(19)), F.lit(0.0), lambda s, j: s + F.log((a + j + 0.5) / (a + j)))
    return F.log(up) / 2 + F.log(series) - down


def _beta_steps(a: Column, b: Column, x: Column, steps: int = 200) -> Column:
    """The continued fraction of the incomplete beta function (Lentz) as a fold over its steps."""
    tiny = F.lit(1e-300)

    def kept(v: Column) -> Column:
        return F.when(F.abs(v) < tiny, tiny).otherwise(v)

    def state(c: Column, d: Column, h: Column) -> Column:
        return F.struct(c.alias("c"), d.alias("d"), h.alias("h"))

    def turn(s: Column, top: Column) -> Column:
        d = 1 / kept(1 + top * s["d"])
        c = 1 + top / kept(s["c"])
        return state(c, d, s["h"] * d * c)

    first = 1 / kept(1 - (a + b) * x / (a + 1))
    # Each step is split in two entries, an even and an odd one, so that no expression repeats the one before.
    def step(s: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return turn(s, F.when(k % 2 == 0, even).otherwise(odd))

    return F.aggregate(F.sequence(F.lit(2), F.lit(2 * steps + 1)), state(F.lit(1.0), first, first), step)["h"]


def student_p_column(t: Column, df: Column) -> Column:
    """P(|T| > |t|) of Student's distribution, NULL without a statistic or degrees of freedom."""
    x = df / (df + t * t)
    x = F.when(t == float("inf"), 0.0).otherwise(x)
    a, half = df / 2, F.lit(0.5)
    direct = x < (a + 1) / (a + 2.5)
    front = F.exp(_log_gamma_step(a) - F.lit(math.log(math.pi) / 2) + a * F.log(x) + half * F.log(1 - x))
    # The fraction converges fast on one side of the mean; beyond it the complement is taken.
    one, two, at = F.when(direct, a).otherwise(half), F.when(direct, half).otherwise(a), F.when(direct, x).otherwise(1 - x)
    part = front * _beta_steps(one, two, at) / one
    p = F.when(direct, part).otherwise(1 - part)
    inner = F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)))
    return F.when(df > 0, inner)


# Coefficients of Acklam's rational approximation of the inverse normal distribution.
_NUMERATOR = [-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00]
_DENOMINATOR = [-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0]
_TAIL_NUMERATOR = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00]
_TAIL_DENOMINATOR = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0]


def _polynomial(coefficients: list[float], x: Column) -> Column:
    out = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_quantile(p: Column) -> Column:
    """Quantile of the standard normal distribution (relative error under 2e-9), for p strictly between 0 and 1."""
    q = p - 0.5
    middle = _polynomial(_NUMERATOR, q * q) * q / _polynomial(_DENOMINATOR, q * q)
    low, high = F.sqrt(-2 * F.log(p)), F.sqrt(-2 * F.log(1 - p))
    tails = [_polynomial(_TAIL_NUMERATOR, r) / _polynomial(_TAIL_DENOMINATOR, r) for r in (low, high)]
    return F.when(p < 0.02425, tails[0]).when(p > 1 - 0.02425, -tails[1]).otherwise(middle)
