"""Tails of distributions as native column expressions: continued fractions and series folded over a fixed number of terms."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Terms of the folded series and fractions, and degrees of freedom from which Student's t is carried over to the normal law.
TERMS, MANY = 300, 20_000.0


def _fold(start: Column, step, terms: int = TERMS, down: bool = True) -> Column:
    k = F.sequence(F.lit(terms), F.lit(1), F.lit(-1)) if down else F.sequence(F.lit(1), F.lit(terms))
    return F.aggregate(k, start, step)


def normal_upper(z: Column) -> Column:
    """P(Z > z) for z >= 0: the odd series below 3, the continued fraction of Mills' ratio from 3 on."""
    z = z.cast("double")
    density = F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    # 1 + z^2/3 (1 + z^2/5 (1 + ...)), from the inside out
    series = _fold(F.lit(1.0), lambda acc, k: 1.0 + acc * z * z / (2.0 * k + 1.0), 80)
    mills = _fold(z, lambda acc, k: z + k / acc, 120)
    return F.when(z < 3, 0.5 - density * z * series).otherwise(density / mills)


def log_gamma(x: Column) -> Column:
    """For x > 0: Stirling's series at x + 10, less the ten factors between."""
    y = x + 10
    stirling = (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return stirling - _fold(F.lit(0.0), lambda acc, k: acc + F.log(x + k - 1), 10)


def beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the regularised incomplete beta function; it converges for x below (a + 1) / (a + b + 2)."""

    def step(acc: Column, m: Column) -> Column:
        odd = -(a + m - 1) * (a + b + m - 1) * x / ((a + 2 * m - 2) * (a + 2 * m - 1))
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        return 1 + odd / (1 + even / acc)

    return _fold(F.lit(1.0), step)


def incomplete_beta(a: Column, b: Column, x: Column) -> Column:
    """I_x(a, b) for 0 <= x <= 1."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    low, high = front / a / beta_fraction(a, b, x), 1 - front / b / beta_fraction(b, a, 1 - x)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1) / (a + b + 2), low).otherwise(high)


def student_two_sided(t: Column, dof: Column) -> Column:
    """P(|T| > |t|) of Student's t; beyond MANY degrees of freedom by Wallace's transformation to the normal law."""
    t, dof = t.cast("double"), dof.cast("double")
    exact = incomplete_beta(dof / 2, F.lit(0.5), dof / (dof + t * t))
    z = (8 * dof + 1) / (8 * dof + 3) * F.sqrt(dof * F.log1p(t * t / dof))
    return F.when(dof > MANY, 2 * normal_upper(z)).otherwise(exact)
