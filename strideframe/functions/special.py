"""Tails of the normal, chi-square and Student t distributions as column expressions.

Each is a series or continued fraction of a fixed number of terms, folded with
``aggregate``: no Python worker, and the same digits on any cluster.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: terms of the series and fractions; both have converged to double precision by then
TERMS = 120
BETA_TERMS = 400


def erfc(x: Column) -> Column:
    """The complementary error function; NULL and NaN stay.

    Below 2 from the series of ``erf`` without alternating signs, from 2 on from
    the continued fraction, evaluated from its far end.
    """
    a = F.abs(x.cast("double"))
    square = F.exp(-a * a)

    def add(acc: Column, k: Column) -> Column:
        term = acc["term"] * 2 * a * a / (2 * k + 1)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    # rows beyond 2 take the fraction: they need no terms here
    near = F.when(a < 2, F.sequence(F.lit(1), F.lit(TERMS))).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(near, F.struct(a.alias("term"), a.alias("sum")), add, lambda acc: acc["sum"])
    inner = F.lit(1.0) - F.lit(2 / math.sqrt(math.pi)) * square * series
    far = F.when(a >= 2, F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    fraction = F.aggregate(far, a, lambda t, k: a + k / (2 * t))
    tail = F.when(a < 2, inner).otherwise(square / (F.lit(math.sqrt(math.pi)) * fraction))
    return F.when(F.isnan(a), a).when(x < 0, 2 - tail).otherwise(tail)


def chi_square_tail(x: Column) -> Column:
    """Upper tail of chi-square with 1 degree of freedom."""
    return erfc(F.sqrt(F.greatest(x, F.lit(0.0)) / 2))


def log_gamma_step(a: Column, shift: int = 12) -> Column:
    """``ln gamma(a + 1/2) - ln gamma(a)`` for ``a > 0``, without the cancellation of two large logarithms."""
    z = a + shift
    inverse = F.lit(1.0) / z
    cube = inverse * inverse * inverse
    series = F.log(z) / 2 - inverse / 8 + cube / 192 - cube * inverse * inverse / 640 + F.lit(17 / 14336) * cube * cube * inverse
    return series + sum((F.log((a + i) / (a + i + 0.5)) for i in range(1, shift)), F.log(a / (a + 0.5)))


def _beta_fraction(x: Column, p: Column, q: Column) -> Column:
    """The continued fraction of the incomplete beta function, from its far end."""

    def down(t: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (q - m) * x / ((p + 2 * m - 1) * (p + 2 * m))
        odd = -(p + m) * (p + q + m) * x / ((p + 2 * m) * (p + 2 * m + 1))
        return F.lit(1.0) + F.when(k % 2 == 0, even).otherwise(odd) / t

    return F.lit(1.0) / F.aggregate(F.sequence(F.lit(BETA_TERMS), F.lit(1), F.lit(-1)), F.lit(1.0), down)


def student_two_sided(t: Column, dof: Column) -> Column:
    """``P(|T| >= |t|)`` for Student's t: the incomplete beta function at ``dof / (dof + t^2)`` for ``(dof / 2, 1 / 2)``."""
    t, dof = t.cast("double"), dof.cast("double")
    a, half = dof / 2, F.lit(0.5)
    square = t * t
    x, y = dof / (dof + square), square / (dof + square)
    # x^a y^(1/2) / B(a, 1/2); the logarithm of x from y, which keeps its digits when dof is large
    front = F.exp(a * F.log1p(-y) + log_gamma_step(a)) * F.sqrt(y) / F.lit(math.sqrt(math.pi))
    straight = front * _beta_fraction(x, a, half) / a
    turned = 1 - front * _beta_fraction(y, half, a) / half
    # with many degrees of freedom 1 - x loses its digits: only far out, where the tail is tiny, does the straight form serve there
    direct = (x < (a + 1) / (a + 2.5)) & ((dof < 1e5) | (square > 25))
    return F.when(t == 0, 1.0).when(F.isnan(t) | F.isnan(dof), F.lit(float("nan"))).when(direct, straight).otherwise(turned)
