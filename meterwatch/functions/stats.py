"""Closed forms and series used by the detectors."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

REGULARISATION = 1e-6
SINGULAR_TOLERANCE = 1e-12


def mahalanobis_2d(dx: Column, dy: Column, vx: Column, vy: Column, cxy: Column) -> tuple[Column, Column]:
    """(distance, Gaussian density) of a centred point under a 2x2 covariance.

    A determinant that is zero up to rounding gets ``REGULARISATION`` on the
    diagonal; float sums hit exactly zero too seldom to test for it.
    """
    raw = vx * vy - cxy * cxy
    singular = raw <= F.lit(SINGULAR_TOLERANCE) * vx * vy
    ax = F.when(singular, vx + F.lit(REGULARISATION)).otherwise(vx)
    ay = F.when(singular, vy + F.lit(REGULARISATION)).otherwise(vy)
    raw_det = ax * ay - cxy * cxy
    det = F.when(raw_det < 1e-300, F.lit(1e-300)).otherwise(raw_det)
    raw_squared = (ay * dx * dx - F.lit(2.0) * cxy * dx * dy + ax * dy * dy) / det
    squared = F.when(raw_squared < 0, F.lit(0.0)).otherwise(raw_squared)  # NULL stays NULL
    density = F.exp(-squared / F.lit(2.0)) / (F.lit(2.0 * math.pi) * F.sqrt(det))
    return F.sqrt(squared), density


def kolmogorov_p(stat: Column, terms: int = 20) -> Column:
    """Upper tail of the Kolmogorov limit law.

    Uses the alternating series above 0.5 and its dual below, where the first
    converges slowly.
    """
    ks = F.sequence(F.lit(1), F.lit(terms))

    def upper(acc: Column, k: Column) -> Column:
        sign = F.when(k % 2 == 1, F.lit(1.0)).otherwise(F.lit(-1.0))
        return acc + sign * F.exp(F.lit(-2.0) * k * k * stat * stat)

    def dual(acc: Column, k: Column) -> Column:
        odd = (k * 2 - 1).cast("double")
        return acc + F.exp(-(odd * odd) * F.lit(math.pi ** 2) / (F.lit(8.0) * stat * stat))

    high = F.lit(2.0) * F.aggregate(ks, F.lit(0.0), upper)
    low = F.lit(1.0) - F.lit(math.sqrt(2 * math.pi)) / stat * F.aggregate(ks, F.lit(0.0), dual)
    value = F.when(stat <= 0, F.lit(1.0)).when(stat < 0.5, low).otherwise(high)
    return F.when(stat.isNotNull(), F.least(F.greatest(value, F.lit(0.0)), F.lit(1.0)))


def student_p_integer(t: Column, dof: Column) -> Column:
    """Two-sided Student p-value for whole degrees of freedom (finite series)."""
    theta = F.atan(F.abs(t) / F.sqrt(dof))
    c2 = F.cos(theta) * F.cos(theta)
    odd = dof % 2 == 1
    # terms after the first: products of (2j)/(2j+1) for odd, (2j-1)/(2j) for even dof
    count = F.greatest(F.when(odd, (dof - 3) / 2).otherwise((dof - 2) / 2).cast("int"), F.lit(0))
    steps = F.when(count > 0, F.sequence(F.lit(1), F.greatest(count, F.lit(1)))).otherwise(
        F.array().cast("array<int>"))

    def add(acc: Column, j: Column) -> Column:
        ratio = F.when(odd, (2.0 * j) / (2.0 * j + 1)).otherwise((2.0 * j - 1) / (2.0 * j))
        term = acc["term"] * ratio * c2
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    one = F.lit(1.0)
    series = F.aggregate(steps, F.struct(one.alias("term"), one.alias("total")), add)["total"]
    sin, cos = F.sin(theta), F.cos(theta)
    inside = F.when(
        odd,
        F.lit(2 / math.pi) * (theta + F.when(dof > 1, sin * cos * series).otherwise(0.0)),
    ).otherwise(sin * series)
    return F.when(dof > 0, F.greatest(F.lit(1.0) - inside, F.lit(0.0)))


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, 300):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + numerator / np.where(np.abs(c) < tiny, tiny, c)
            value = value * c * d
        if np.nanmax(np.abs(c * d - 1.0), initial=0.0) < 1e-14:
            break
    return value


def student_p(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """Two-sided Student p-value for any positive degrees of freedom."""
    t, dof = np.asarray(t, float), np.asarray(dof, float)
    a, b = dof / 2.0, np.full_like(dof, 0.5)
    x = np.clip(dof / (dof + t * t), 1e-300, 1 - 1e-16)
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(x) + b * np.log1p(-x))
    direct = x < (a + 1) / (a + b + 2)
    value = np.where(
        direct,
        front * _beta_fraction(a, b, x) / a,
        1.0 - front * _beta_fraction(b, a, 1 - x) / b,
    )
    return np.clip(value, 0.0, 1.0)


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return np.vectorize(lambda v: math.erfc(abs(v) / math.sqrt(2)), otypes=[float])(np.asarray(z, float))
