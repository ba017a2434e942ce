"""Distribution functions for significance tests, evaluated on one aggregated row.

The statistics themselves (counts, means, variances) are computed by Spark aggregates; only
the final CDF of a scalar is evaluated here, inside a pandas UDF on the one-row result.
"""

from __future__ import annotations

import math


def _betacf(a: float, b: float, x: float) -> float:
    # Continued fraction for the regularized incomplete beta (modified Lentz method).
    tiny, eps = 1e-300, 1e-15
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 1_000_000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            return h
    raise ArithmeticError(f"the incomplete beta function did not converge at {a}, {b}, {x}")


def betainc(a: float, b: float, x: float) -> float:
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_two_sided_p(t: float | None, dof: float | None) -> float | None:
    """Two-sided p-value of Student's t with ``dof`` degrees of freedom."""
    if t is None or dof is None or dof <= 0 or (isinstance(t, float) and math.isnan(t)):
        return None
    if math.isinf(t):
        return 0.0
    if dof > 1e5:  # by now the normal limit with its first corrections is the more exact one
        z = abs(t) * (1 - 1 / (4 * dof)) / math.sqrt(1 + t * t / (2 * dof))
        return math.erfc(z / math.sqrt(2))
    return betainc(dof / 2.0, 0.5, dof / (dof + t * t))


def binom_two_sided_p_half(k: int, n: int) -> float | None:
    """Exact two-sided binomial test with p = 0.5."""
    if n is None or n <= 0:
        return None
    m = min(k, n - k)
    if 2 * m == n:
        return 1.0
    # the lower tail P(X <= m) as an incomplete beta function; above 1e6, where that loses digits, the
    # normal limit with continuity correction
    if n > 1_000_000:
        return min(1.0, math.erfc((n / 2 - m - 0.5) / math.sqrt(n / 2)))
    return min(1.0, 2.0 * betainc(n - m, m + 1, 0.5))
