"""Tail probabilities for test statistics: a few numbers per year and variable."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _beta_fraction(a: float, b: float, x: float) -> float | None:
    """Continued fraction of the incomplete beta function, evaluated from the front; None if it does not settle.

    It takes some times the square root of the larger parameter.
    """
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    total = d
    for m in range(1, 1000 + int(20 * math.sqrt(max(a, b)))):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for coefficient in (even, odd):
            d = 1.0 + coefficient * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + coefficient / c
            c = c if abs(c) > tiny else tiny
            total *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return total
    return None


def _stirling_rest(z: float) -> float:
    """What Stirling's formula lacks of the logarithm of the gamma function."""
    if z < 12.0:
        return math.lgamma(z) - (z - 0.5) * math.log(z) + z - 0.5 * math.log(2.0 * math.pi)
    return (1.0 / 12.0 - (1.0 / 360.0 - 1.0 / (1260.0 * z * z)) / (z * z)) / z


def _excess(part: float, expected: float) -> float:
    """part * log(part / expected) - (part - expected), without cancellation where both are close."""
    u = (part - expected) / expected
    if abs(u) > 0.1:
        return part * math.log(part / expected) - (part - expected)
    term, total = u * u, 0.0
    for k in range(2, 40):
        total += term / (k * (k - 1))
        term *= -u
    return expected * total


def beta_cdf(x: float, a: float, b: float, rest: float | None = None) -> float | None:
    """Regularised incomplete beta function; None if its fraction does not settle. ``rest`` is 1 - x, where it is known better.

    The factor before the fraction is a binomial deviance, as differences of logarithms of the
    gamma function lose all digits for large parameters.
    """
    if x <= 0.0 or (x >= 1.0 and not rest):
        return 0.0 if x <= 0.0 else 1.0
    n, rest = a + b, 1.0 - x if rest is None else rest
    log_front = (
        0.5 * math.log(a / n * b / (2.0 * math.pi))
        + _stirling_rest(n) - _stirling_rest(a) - _stirling_rest(b)
        - _excess(a, n * x) - _excess(b, n * rest)
    )
    front = math.exp(log_front)
    lower = x < (a + 1.0) / (a + b + 2.0)
    fraction = _beta_fraction(a, b, x) if lower else _beta_fraction(b, a, rest)
    if fraction is None:
        return None
    return front * fraction / a if lower else 1.0 - front * fraction / b


def f_upper(f: float, d1: float, d2: float) -> float | None:
    """P(F > f) for an F distribution with ``d1`` and ``d2`` degrees of freedom."""
    if f is None or math.isnan(f) or d1 <= 0 or d2 <= 0:
        return None
    if math.isinf(f):
        return 0.0
    whole = d2 + d1 * f
    return beta_cdf(d2 / whole, d2 / 2.0, d1 / 2.0, d1 * f / whole)


def kolmogorov_upper(d: float, n: float) -> float | None:
    """P(D > d) of the one-sample two-sided statistic, limit law with a sample-size correction.

    The statistic is shifted to ``z + 1/(6 sqrt n) + (z - 1)/(4n)`` before the
    Kolmogorov series, which keeps three digits from some ten values on.
    """
    if d is None or n is None or math.isnan(d) or n <= 0:
        return None
    root = math.sqrt(n)
    z = root * d
    z += 1.0 / (6.0 * root) + (z - 1.0) / (4.0 * n)
    if z <= 0.05:
        return 1.0
    if z < 1.0:
        # The series of the lower tail converges faster here.
        terms = (math.exp(-((2 * k - 1) ** 2) * math.pi**2 / (8.0 * z * z)) for k in range(1, 8))
        return 1.0 - math.sqrt(2.0 * math.pi) / z * sum(terms)
    terms = ((-1) ** (k - 1) * math.exp(-2.0 * k * k * z * z) for k in range(1, 30))
    return min(1.0, 2.0 * sum(terms))


def _rowwise(function, *columns: pd.Series) -> pd.Series:
    values = [
        None if any(pd.isna(v) for v in row) else function(*(float(v) for v in row)) for row in zip(*columns)
    ]
    return pd.Series(values, dtype="float64")


@F.pandas_udf(DoubleType())
def f_upper_tail(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return _rowwise(f_upper, f, d1, d2)


@F.pandas_udf(DoubleType())
def kolmogorov_upper_tail(d: pd.Series, n: pd.Series) -> pd.Series:
    return _rowwise(kolmogorov_upper, d, n)


NODE = 1.0 / 64.0


def normal_lower(x: np.ndarray) -> np.ndarray:
    """Standard normal distribution function, with an error below 1e-15.

    A Taylor polynomial of degree six around the nearest of some nodes; its rest is below 1e-16.
    """
    node = np.arange(-9 * 64, 9 * 64 + 1) * NODE
    at_node = np.array([0.5 * math.erfc(-v / math.sqrt(2.0)) for v in node.tolist()])
    inside = np.clip(x, -9.0, 9.0)
    k = np.rint(np.nan_to_num(inside) / NODE).astype(np.int64) + 9 * 64
    v = node[k]
    d = inside - v
    w = v * v
    slope = np.exp(-0.5 * w) / math.sqrt(2.0 * math.pi)
    last = -v * (w * (w - 10.0) + 15.0) * d / 6.0 + (w * (w - 6.0) + 3.0)
    series = 1.0 + d * (-v / 2.0 + d * ((w - 1.0) / 6.0 + d * (-v * (w - 3.0) / 24.0 + d * last / 120.0)))
    return at_node[k] + slope * d * series


@F.pandas_udf(DoubleType())
def normal_cdf(z: pd.Series) -> pd.Series:
    return pd.Series(normal_lower(z.to_numpy(dtype="float64", na_value=np.nan)))
