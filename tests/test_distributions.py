"""Distribution expressions against the closed forms and the scalar versions in Python."""

import math
import random

from pyspark.sql import functions as F

from quarry.functions import distributions as D
from quarry.functions.stats import betainc, t_two_sided_p
from quarry.operators import evaluate as E


def _values(spark, rows, schema, column):
    return [r.x for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", column.alias("x")).orderBy("i").collect()]


def test_log_gamma(spark):
    xs = [(v,) for v in (0.01, 0.5, 1.0, 2.0, 3.7, 10.0, 171.5, 1e4, 1e6)]
    got = _values(spark, xs, "v double", D.log_gamma(F.col("v")))
    for (v,), g in zip(xs, got, strict=True):
        assert abs(g - math.lgamma(v)) < 1e-11 * max(1.0, abs(math.lgamma(v)))


def test_beta_inc(spark):
    rng = random.Random(1)
    rows = [(rng.choice([0.5, 1.0, 2.5, 30.0, 900.0, 40_000.0]), rng.choice([0.5, 1.0, 7.0]), rng.random()) for _ in range(60)] + [(2.0, 3.0, 0.0), (2.0, 3.0, 1.0)]
    got = _values(spark, rows, "a double, b double, v double", D.beta_inc(F.col("a"), F.col("b"), F.col("v")))
    for r, g in zip(rows, got, strict=True):
        assert abs(g - betainc(*r)) < 1e-9


def test_normal_cdf(spark):
    xs = [(v / 4,) for v in range(-60, 61)]
    got = _values(spark, xs, "v double", D.normal_cdf(F.col("v")))
    for (v,), g in zip(xs, got, strict=True):
        want = 0.5 * math.erfc(-v / math.sqrt(2))
        assert abs(g - want) < 1e-13 and (v > 0 or abs(g / want - 1) < 1e-9)


def test_t_two_sided(spark):
    rows = [(t, n) for t in (0.0, 0.3, -2.0, 7.5, 40.0) for n in (1.0, 2.0, 19.0, 500.0, 99_999.0, 2e6)] + [(None, 3.0), (float("nan"), 3.0), (1.0, 0.0), (float("inf"), 4.0)]
    got = _values(spark, rows, "t double, n double", D.t_two_sided(F.col("t"), F.col("n")))
    for (t, n), g in zip(rows, got, strict=True):
        want = t_two_sided_p(t, n)
        assert g is want or abs(g - want) < 1e-8


def test_kolmogorov_p(spark):
    rows = [(d, n) for d in (0.001, 0.05, 0.1, 0.3, 0.9) for n in (5, 100, 4000)]
    got = _values(spark, rows, "d double, n long", D.kolmogorov_p(F.col("d"), F.col("n")))
    for (d, n), g in zip(rows, got, strict=True):
        s = (math.sqrt(n) + 0.12 + 0.11 / math.sqrt(n)) * d
        # the theta function's other series, which converges where this one does not
        want = 1 - math.sqrt(2 * math.pi) / s * sum(math.exp(-((2 * i - 1) ** 2) * math.pi**2 / (8 * s * s)) for i in range(1, 200))
        assert abs(g - min(1.0, max(0.0, want))) < 1e-9


def test_ks_of_groups_equals_brute_force_and_the_single_test(spark):
    rng = random.Random(4)
    rows = [(s, i, round(rng.gauss(m, 1.0), 1)) for s, m in (("a", 0.0), ("b", 0.7)) for i in range(60)] + [("a", 99, None), ("c", 1, 0.0)]
    df = spark.createDataFrame(rows, "system string, query_id long, x double")
    got = {r.system: r for r in E.ks_normal_by(df, "system", "x", "query_id").collect()}
    for s in "abc":
        v = sorted(x for t, _, x in rows if t == s and x is not None)
        cdf = [0.5 * math.erfc(-x / math.sqrt(2)) for x in v]
        want = max(max((i + 1) / len(v) - c, c - i / len(v)) for i, c in enumerate(cdf))
        assert got[s].n == len(v) and abs(got[s].statistic - want) < 1e-12
    exact = E.ks_normal(df.where("system = 'b' AND x IS NOT NULL"), "x").first()
    assert abs(got["b"].statistic - exact.statistic) < 1e-9 and abs(got["b"].p_value - exact.pValue) < 0.01
