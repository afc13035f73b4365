"""Tail probabilities for small result tables (one row per tested column)."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# executors get these helpers with the task, so they need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _settled(c: float, d: float) -> bool:
    return abs(c * d - 1) < 1e-15


def student_two_sided(t: float, dof: float) -> float:
    """P(|T| >= t): incomplete beta function by its continued fraction, for many degrees of freedom an expansion of the normal tail."""
    if dof > 1000:
        a = dof - 0.5
        b, y = 48 * a * a, a * math.log1p(t * t / dof)
        z = (((((-0.4 * y - 3.3) * y - 24) * y - 85.5) / (0.8 * y * y + 100 + b) + y + 3) / b + 1) * math.sqrt(y)
        return math.erfc(z / math.sqrt(2))
    a, b = dof / 2, 0.5
    x = dof / (dof + t * t)
    if x >= 1 or x <= 0:
        return 1.0 if x >= 1 else 0.0
    flip = x > (a + 1) / (a + b + 2)
    if flip:
        a, b, x = b, a, 1 - x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    f = d
    for m in range(1, 10_000):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 / (1 + num * d or tiny)
            c = 1 + num / c or tiny
            f *= c * d
        if _settled(c, d):
            p = front * f
            return 1 - p if flip else p
    raise ArithmeticError("the tail did not converge")


def chi_square_tail(x: float, dof: float) -> float:
    """P(X >= x): incomplete gamma function by its series or continued fraction."""
    if x <= 0:
        return 1.0
    a, h = dof / 2, x / 2
    front = math.exp(a * math.log(h) - h - math.lgamma(a))
    if h < a + 1:
        term = total = 1 / a
        n = a
        while term > total * 1e-16:
            n += 1
            term *= h / n
            total += term
        return 1 - front * total
    tiny = 1e-300
    b = h + 1 - a
    c, d = 1 / tiny, 1 / b
    f = d
    for i in range(1, 1_000_000):
        num = -i * (i - a)
        b += 2
        d = 1 / (num * d + b or tiny)
        c = b + num / c or tiny
        f *= c * d
        if _settled(c, d):
            return front * f
    raise ArithmeticError("the tail did not converge")


@F.pandas_udf(DoubleType())
def chi_square_pvalue(x: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([chi_square_tail(a, b) if b and b > 0 else float("nan") for a, b in zip(x, dof)])


@F.pandas_udf(DoubleType())
def t_pvalue(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of a correlation r over n pairs."""
    def one(r: float, n: float) -> float:
        if r is None or math.isnan(r) or n < 3:
            return float("nan")
        if abs(r) >= 1:
            return 0.0
        return student_two_sided(abs(r) * math.sqrt((n - 2) / (1 - r * r)), n - 2)

    return pd.Series([one(a, b) for a, b in zip(r, n)])
