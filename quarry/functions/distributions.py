"""Distribution functions as column expressions: series and continued fractions over a fixed sequence.

They are meant for rows that hold a whole test's statistic, a row per test. Steps beyond convergence
change nothing, so each function takes a fixed number of them; the comments say what that suffices for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TINY = 1e-300


def _steps(n: int) -> Column:
    return F.sequence(F.lit(1), F.lit(n))


def _with(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once."""
    return F.transform(F.array(value), fn)[0]


def log_gamma(x: Column) -> Column:
    """ln gamma(x), x > 0: Stirling's series at x + 8 (error below 1e-13), brought back by eight factors."""
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, F.lit(5))) - 1 / (1680 * F.pow(y, F.lit(7)))
    back = F.log(x)
    for i in range(1, 8):
        back = back + F.log(x + i)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - back


def _beta_fraction(a: Column, b: Column, x: Column, steps: int) -> Column:
    """The continued fraction of the incomplete beta function, by Lentz's method."""
    full = lambda v: F.when(F.abs(v) < TINY, F.lit(TINY)).otherwise(v)

    def turn(s: Column, coefficient: Column) -> Column:
        d = 1 / full(1 + coefficient * s["d"])
        c = full(1 + coefficient / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def step(s: Column, i: Column) -> Column:
        m = i.cast("double")
        even = m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))
        return _with(turn(s, even), lambda t: turn(t, odd))

    d = 1 / full(1 - (a + b) * x / (a + 1))
    return F.aggregate(_steps(steps), F.struct(F.lit(1.0).alias("c"), d.alias("d"), d.alias("h")), step, lambda s: s["h"])


def beta_inc(a: Column, b: Column, x: Column, steps: int = 400) -> Column:
    """The regularized incomplete beta function. 400 steps converge where the larger of a and b is at most
    50,000 (they grow with its root)."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log1p(-x))
    low = front * _beta_fraction(a, b, x, steps) / a
    high = 1 - front * _beta_fraction(b, a, 1 - x, steps) / b
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).when(x < (a + 1) / (a + b + 2), low).otherwise(high)


def normal_cdf(x: Column, steps: int = 120) -> Column:
    """The standard normal distribution function: its power series up to 4 deviations, beyond them the
    continued fraction of the tail, which keeps small probabilities exact."""
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)

    def term(s: Column, i: Column) -> Column:
        t = s["t"] * x * x / (2 * i + 1)
        return F.struct(t.alias("t"), (s["s"] + t).alias("s"))

    series = F.aggregate(_steps(steps), F.struct(x.alias("t"), x.alias("s")), term, lambda s: s["s"])
    away = F.abs(x)
    tail = density / F.aggregate(F.reverse(_steps(steps)), away, lambda f, i: away + i / f)
    return F.when(away <= 4, 0.5 + density * series).when(x > 0, 1 - tail).otherwise(tail)


def t_two_sided(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t; null without a t or degrees of freedom. Above 1e5 degrees the normal
    limit with its first corrections is the more exact one."""
    t, n = t.cast("double"), dof.cast("double")
    exact = beta_inc(n / 2, F.lit(0.5), n / (n + t * t))
    z = F.abs(t) * (1 - 1 / (4 * n)) / F.sqrt(1 + t * t / (2 * n))
    p = F.when(n <= 1e5, exact).otherwise(2 * normal_cdf(-z))
    return F.when(t.isNull() | F.isnan(t) | n.isNull() | (n <= 0), F.lit(None)).when(F.abs(t) == float("inf"), 0.0).otherwise(p)


def kolmogorov_p(d: Column, n: Column, steps: int = 100) -> Column:
    """P-value of a Kolmogorov-Smirnov statistic ``d`` of ``n`` values by the limiting distribution, with
    Stephens' correction for finite n: twice the alternating sum of exp(-2 i^2 s^2). Below s = 0.2 it is 1
    to all digits."""
    s = (F.sqrt(n.cast("double")) + 0.12 + 0.11 / F.sqrt(n.cast("double"))) * d
    total = F.aggregate(_steps(steps), F.lit(0.0), lambda a, i: a + F.when(i % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * i * i * s * s))
    return F.when(s < 0.2, 1.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * total)))
