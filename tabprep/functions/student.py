"""Two-sided p-value of Student's t. Spark SQL has no such function, so a small vector function supplies it.

p = I(df / (df + t^2); df / 2, 1 / 2), the regularised incomplete beta function, by its continued fraction
(Abramowitz and Stegun 26.5.8, evaluated with the modified Lentz method). From LARGE degrees of freedom on, where the
fraction loses digits, Fisher's expansion around the normal limit takes over. It is applied to report rows only.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS = 100_000
TINY = 1e-300
LARGE = 1e7


def _fraction(a: float, b: float, x: float) -> float:
    """The continued fraction of the incomplete beta function."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > TINY else TINY)
    total = d
    for m in range(1, STEPS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = 1.0
        for term in (even, odd):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > TINY else TINY)
            c = 1.0 + term / c
            c = c if abs(c) > TINY else TINY
            step = c * d
            total *= step
        if abs(step - 1.0) < 1e-15:
            return total
    raise ArithmeticError(f"the fraction did not converge for {a}, {b}, {x}")


def log_gamma_half_step(a: float) -> float:
    """lgamma(a + 1/2) - lgamma(a), without the difference of two large numbers."""
    if a < 20.0:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    return 0.5 * math.log(a) - 1 / (8 * a) + 1 / (192 * a**3) - 1 / (640 * a**5) + 17 / (14336 * a**7)


def _by_fraction(t: float, dof: float) -> float:
    a, b, square = dof / 2.0, 0.5, t * t
    x, rest = dof / (dof + square), square / (dof + square)
    if rest == 0.0:
        return 1.0
    front = math.exp(
        log_gamma_half_step(a) - math.lgamma(b) - a * math.log1p(square / dof) + b * math.log(rest)
    )
    # The fraction converges fast on this side of the mean; the other side follows by symmetry.
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _fraction(a, b, x) / a
    return 1.0 - front * _fraction(b, a, rest) / b


def _by_expansion(t: float, dof: float) -> float:
    t = abs(t)
    density = math.exp(-0.5 * t * t) / math.sqrt(2.0 * math.pi)
    first = (t**3 + t) / (4.0 * dof)
    second = (3 * t**7 - 5 * t**5 - 7 * t**3 - 3 * t) / (96.0 * dof * dof)
    return math.erfc(t / math.sqrt(2.0)) + 2.0 * density * (first + second)


def two_sided_p(t: float | None, dof: float | None) -> float | None:
    if t is None or dof is None or math.isnan(t) or math.isnan(dof) or dof <= 0:
        return None
    if math.isinf(t) or t * t > 1e300:
        return 0.0
    return _by_expansion(t, dof) if dof >= LARGE and abs(t) < 40.0 else _by_fraction(t, dof)


def _p_values(t: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([two_sided_p(a, b) for a, b in zip(t, dof)], dtype="float64")


def t_test_p(t: Column, dof: Column) -> Column:
    return F.pandas_udf(_p_values, "double")(t, dof.cast("double"))
