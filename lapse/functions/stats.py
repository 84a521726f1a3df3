"""Closed-form statistics as column expressions (no Python in the data path).

Spark ships no ``erf``. Up to ``CUT`` it is summed as a series of positive terms; beyond, its complement is a continued
fraction, so that tails keep their relative accuracy (about 1e-13) however small they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Where the series gives way to the continued fraction.
CUT = 2.0
#: Terms and levels that leave nothing of a double below and above ``CUT``.
TERMS, LEVELS = 40, 50


def _erf_below(x: Column) -> Column:
    """2 x exp(-x^2) / sqrt(pi) * sum (2 x^2)^n / (1 * 3 * ... * (2 n + 1))."""
    t = F.lit(2.0) * x * x
    total = F.lit(1.0)
    for n in range(TERMS, 0, -1):
        total = F.lit(1.0) + t / F.lit(2.0 * n + 1.0) * total
    return F.lit(2.0 / math.sqrt(math.pi)) * x * F.exp(-(x * x)) * total


def _erfc_above(x: Column) -> Column:
    """exp(-x^2) / sqrt(pi) / (x + (1/2) / (x + 1 / (x + (3/2) / (x + ...))))."""
    rest = x
    for n in range(LEVELS, 0, -1):
        rest = x + F.lit(n / 2.0) / rest
    return F.exp(-(x * x)) / F.lit(math.sqrt(math.pi)) / rest


def erf(x: Column) -> Column:
    ax = F.abs(x)
    return F.signum(x) * F.when(ax < CUT, _erf_below(ax)).when(ax >= CUT, F.lit(1.0) - _erfc_above(ax))


def erfc(x: Column) -> Column:
    """1 - erf, without taking a difference where it is small."""
    ax = F.abs(x)
    beyond = F.when(ax < CUT, F.lit(1.0) - _erf_below(ax)).when(ax >= CUT, _erfc_above(ax))
    return F.when(x >= 0, beyond).when(x < 0, F.lit(2.0) - beyond)


def norm_cdf(z: Column) -> Column:
    """Standard normal CDF; its lower tail is a complement and keeps its digits."""
    return F.lit(0.5) * erfc(-z / F.lit(math.sqrt(2.0)))


def chi2_sf_df1(stat: Column) -> Column:
    """Upper tail of the chi-square distribution with one degree of freedom."""
    return erfc(F.sqrt(stat / F.lit(2.0)))
