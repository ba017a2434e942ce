"""Evaluation and significance queries over three systems on the judged pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import evaluate as E
from quarry.operators.util import materialize
from quarry.plans import sql as Q
from quarry.plans.rank_plans import PAIR_TF_SQL, PAIR_TFIDF_SQL
from quarry.plans.registry import register
from quarry.sources.tables import judgments, read_table, spread

K = 10

RANKINGS_SQL = f"""{Q.JUDG}, {PAIR_TF_SQL}, {PAIR_TFIDF_SQL},
rk AS (
  SELECT 'baseline' AS system, query_id, doc_id, label, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank FROM judg
  UNION ALL SELECT 'tf', query_id, doc_id, label, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, doc_id) FROM pt
  UNION ALL SELECT 'tfidf', query_id, doc_id, label, row_number() OVER (PARTITION BY query_id ORDER BY tfidf DESC, doc_id) FROM ptf),
gain AS (SELECT *, CASE label WHEN 'E' THEN 4 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END AS g FROM rk),
dcg AS (SELECT system, query_id, {Q.ordered_sum('rank', 'g / log2(rank + 1)')} AS dcg FROM gain WHERE rank <= {K} GROUP BY system, query_id),
ideal AS (SELECT query_id, {Q.ordered_sum('r', 'g / log2(r + 1)')} AS ideal_dcg FROM (
  SELECT query_id, CASE label WHEN 'E' THEN 4 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END AS g,
         row_number() OVER (PARTITION BY query_id ORDER BY CASE label WHEN 'E' THEN 4 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END DESC, doc_id) AS r
  FROM judg) WHERE r <= {K} GROUP BY query_id),
nd AS (SELECT system, query_id, dcg / ideal_dcg AS ndcg FROM dcg JOIN ideal USING (query_id) WHERE ideal_dcg > 0),
pr AS (SELECT query_id, max(CASE WHEN system = 'tf' THEN ndcg END) AS a, max(CASE WHEN system = 'baseline' THEN ndcg END) AS b
       FROM nd WHERE system IN ('baseline', 'tf') GROUP BY query_id HAVING a IS NOT NULL AND b IS NOT NULL)"""


def _docs(spark, d):
    return spread(read_table(spark, d, "documents").select("doc_id", "text"))


def _rankings(spark, d):
    return E.system_rankings(judgments(spark, d), _docs(spark, d), K)


def _ndcg(spark, d):
    return E.ndcg_at_k(_rankings(spark, d), judgments(spark, d).select("query_id", "doc_id", "label"), K)


def _pairs(spark, d):
    """(improved, baseline) per query."""
    return E.paired(_ndcg(spark, d), "tf", "baseline")


@register(
    "eval_precision_at_k",
    f"""WITH {RANKINGS_SQL} SELECT system, round(avg(p), 6) AS p_at_10 FROM (
          SELECT system, query_id, avg(CASE WHEN label <> 'I' THEN 1.0 ELSE 0.0 END) AS p FROM rk WHERE rank <= {K}
          GROUP BY system, query_id) GROUP BY system""",
)
def eval_precision_at_k(spark, d):
    return E.precision_at_k(_rankings(spark, d), K).select("system", F.round("p_at_10", 6).alias("p_at_10"))


@register(
    "eval_map",
    f"""WITH {RANKINGS_SQL}, c AS (SELECT *, CASE WHEN label <> 'I' THEN 1 ELSE 0 END AS rel,
          sum(CASE WHEN label <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY system, query_id ORDER BY rank
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM rk),
        ap AS (SELECT system, query_id, sum(CASE WHEN rel = 1 THEN cum / rank END) / sum(rel) AS ap FROM c
               GROUP BY system, query_id HAVING sum(rel) > 0)
        SELECT system, round(avg(ap), 6) AS map FROM ap GROUP BY system""",
)
def eval_map(spark, d):
    return E.mean_average_precision(E.system_scores(judgments(spark, d), _docs(spark, d))).select("system", F.round("map", 6).alias("map"))


@register("eval_dcg", f"WITH {RANKINGS_SQL} SELECT system, query_id, round(dcg, 6) AS dcg FROM dcg")
def eval_dcg(spark, d):
    return E.dcg_at_k(_rankings(spark, d), K).select("system", "query_id", F.round("dcg", 6).alias("dcg"))


@register("eval_ideal_dcg", f"WITH {RANKINGS_SQL} SELECT query_id, round(ideal_dcg, 6) AS ideal_dcg FROM ideal")
def eval_ideal_dcg(spark, d):
    return E.ideal_dcg_at_k(judgments(spark, d), K).select("query_id", F.round("ideal_dcg", 6).alias("ideal_dcg"))


@register("eval_ndcg", f"WITH {RANKINGS_SQL} SELECT system, query_id, round(ndcg, 6) AS ndcg FROM nd")
def eval_ndcg(spark, d):
    return _ndcg(spark, d).select("system", "query_id", F.round("ndcg", 6).alias("ndcg"))


@register(
    "eval_compare_systems",
    f"""WITH {RANKINGS_SQL} SELECT system, round(avg(dcg), 6) AS mean_dcg, round(mean_ndcg, 6) AS mean_ndcg
        FROM dcg JOIN (SELECT system, avg(ndcg) AS mean_ndcg FROM nd GROUP BY system) USING (system)
        GROUP BY system, mean_ndcg""",
)
def eval_compare_systems(spark, d):
    judged = materialize(judgments(spark, d))  # pairs made once
    r = materialize(E.system_rankings(judged, _docs(spark, d), K))
    dcg = E.dcg_at_k(r, K).groupBy("system").agg(F.avg("dcg").alias("mean_dcg"))
    nd = E.ndcg_at_k(r, judged.select("query_id", "doc_id", "label"), K).groupBy("system").agg(F.avg("ndcg").alias("mean_ndcg"))
    return dcg.join(nd, "system").select("system", F.round("mean_dcg", 6).alias("mean_dcg"), F.round("mean_ndcg", 6).alias("mean_ndcg"))


@register(
    "eval_sign_counts",
    f"WITH {RANKINGS_SQL} SELECT count_if(a > b) AS a_wins, count_if(b > a) AS b_wins FROM pr",
)
def eval_sign_counts(spark, d):
    return E.sign_counts(_pairs(spark, d))


@register(
    "test_sign_binomial",
    f"""WITH {RANKINGS_SQL}, c AS (SELECT count_if(a > b)::BIGINT AS a_wins, count_if(b > a)::BIGINT AS b_wins FROM pr)
        SELECT a_wins, b_wins, round(CASE WHEN a_wins + b_wins = 0 THEN NULL
            WHEN 2 * least(a_wins, b_wins) = a_wins + b_wins THEN 1.0
            ELSE least(1.0, 2 * list_sum(list_transform(range(0, least(a_wins, b_wins) + 1),
                 lambda i: exp(lgamma(a_wins + b_wins + 1) - lgamma(i + 1) - lgamma(a_wins + b_wins - i + 1)
                               - (a_wins + b_wins) * ln(2))))) END, 6) AS p_value FROM c""",
)
def test_sign_binomial(spark, d):
    out = E.binomial_sign_test(_pairs(spark, d))
    return out.select("a_wins", "b_wins", F.round("p_value", 6).alias("p_value"))


@register(
    "test_paired_t",
    f"""WITH {RANKINGS_SQL} SELECT count(*) AS n, round(avg(a - b), 6) AS mean_diff,
        round(avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))), 6) AS t FROM pr""",
)
def test_paired_t(spark, d):
    t = E.paired_t(_pairs(spark, d))
    return t.select("n", F.round("mean_diff", 6).alias("mean_diff"), F.round("t", 6).alias("t"))


def _t_p_sql(stats: str) -> str:
    """``stats`` (a table expression with t and n) with p_value: the incomplete beta function by its continued
    fraction, a recursive table of at most 400 turns per test, started where it converges."""
    a = "CASE WHEN low THEN a ELSE b END"
    b = "CASE WHEN low THEN b ELSE a END"
    y = "CASE WHEN low THEN x ELSE 1 - x END"
    return f"""st AS (SELECT row_number() OVER () AS test, * FROM {stats}),
bx AS (SELECT *, (n - 1) / 2.0 AS a, 0.5::DOUBLE AS b, (n - 1) / (n - 1 + t * t) AS x FROM st WHERE n > 1 AND isfinite(t) AND t <> 0),
lo AS (SELECT *, x < (a + 1) / (a + b + 2) AS low FROM bx),
ab AS (SELECT test, {a} AS a, {b} AS b, {y} AS x, low FROM lo),
cf AS (SELECT test, 0 AS m, 1.0::DOUBLE AS c, 1 / (1 - (a + b) * x / (a + 1)) AS d, 1 / (1 - (a + b) * x / (a + 1)) AS h, a, b, x, low FROM ab
  UNION ALL
  SELECT test, m, c + 0, d, h * c * d, a, b, x, low FROM (
    SELECT test, m, 1 + o / c AS c, 1 / (1 + o * d) AS d, h, a, b, x, low FROM (
      SELECT test, m, c, d, h * c * d AS h, a, b, x, low, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m)) AS o FROM (
        SELECT test, m, 1 + e / c AS c, 1 / (1 + e * d) AS d, h, a, b, x, low FROM (
          SELECT test, m + 1 AS m, c, d, h, a, b, x, low, (m + 1) * (b - m - 1) * x / ((a - 1 + 2 * (m + 1)) * (a + 2 * (m + 1))) AS e FROM cf WHERE m < 400))))),
ib AS (SELECT test, CASE WHEN low THEN f ELSE 1 - f END AS p FROM (
  SELECT test, low, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(x) + b * ln(1 - x)) * h / a AS f FROM cf WHERE m = 400)),
pv AS (SELECT st.*, CASE WHEN t = 0 THEN 1.0 ELSE p END AS p_value FROM st LEFT JOIN ib USING (test))"""


@register(
    "test_paired_t_p",
    f"""WITH RECURSIVE {RANKINGS_SQL},
        tt AS (SELECT count(*) AS n, avg(a - b) AS mean_diff, avg(a - b) / (stddev_samp(a - b) / sqrt(count(*))) AS t FROM pr),
        {_t_p_sql('tt')} SELECT n, round(mean_diff, 6) AS mean_diff, round(t, 6) AS t, round(p_value, 6) AS p_value FROM pv""",
)
def test_paired_t_p(spark, d):
    """t statistic with its two-sided p-value (Student's distribution as a column expression)."""
    return E.paired_t_test(_pairs(spark, d)).select("n", *[F.round(c, 6).alias(c) for c in ("mean_diff", "t", "p_value")])


_T = "avg(a.ndcg - b.ndcg) / (stddev_samp(a.ndcg - b.ndcg) / sqrt(count(*)))"


@register(
    "test_bonferroni",
    f"""WITH {RANKINGS_SQL} SELECT a.system AS system_a, b.system AS system_b, count(*) AS n,
          round(avg(a.ndcg - b.ndcg), 6) AS mean_diff, round({_T}, 6) AS t
        FROM nd a JOIN nd b ON a.query_id = b.query_id AND a.system > b.system GROUP BY a.system, b.system""",
)
def test_bonferroni(spark, d):
    """Paired t-tests (improved minus baseline) for every pair of the systems in one plan."""
    t = E.paired_t_by_pair(_ndcg(spark, d))
    return t.select("system_a", "system_b", "n", F.round("mean_diff", 6).alias("mean_diff"), F.round("t", 6).alias("t"))


@register(
    "test_bonferroni_p",
    f"""WITH RECURSIVE {RANKINGS_SQL},
        tt AS (SELECT a.system AS system_a, b.system AS system_b, count(*) AS n, avg(a.ndcg - b.ndcg) AS mean_diff, {_T} AS t
               FROM nd a JOIN nd b ON a.query_id = b.query_id AND a.system > b.system GROUP BY a.system, b.system),
        {_t_p_sql('tt')} SELECT system_a, system_b, n, round(mean_diff, 6) AS mean_diff, round(t, 6) AS t, round(p_value, 6) AS p_value,
          round(p_value * 3, 6) AS p_bonferroni FROM pv""",
)
def test_bonferroni_p(spark, d):
    """The same tests with p-values and their Bonferroni correction m(m-1)/2 * p."""
    t = E.with_t_p_value(E.paired_t_by_pair(_ndcg(spark, d)))
    t = t.withColumn("p_bonferroni", E.bonferroni(F.col("p_value"), 3))
    return t.select("system_a", "system_b", "n", *[F.round(c, 6).alias(c) for c in ("mean_diff", "t", "p_value", "p_bonferroni")])


@register(
    "test_ks_systems",
    f"""WITH RECURSIVE {RANKINGS_SQL},
        kr AS (SELECT system, ndcg AS x, row_number() OVER (PARTITION BY system ORDER BY ndcg, query_id) AS r, count(*) OVER (PARTITION BY system) AS n FROM nd),
        se AS (SELECT system, r, n, x, 0 AS i, x AS t, x AS s FROM kr
               UNION ALL SELECT system, r, n, x, i + 1, t * x * x / (2 * (i + 1) + 1), s + t * x * x / (2 * (i + 1) + 1) FROM se WHERE i < 60),
        ks AS (SELECT system, n, max(greatest(r / n - c, c - (r - 1) / n)) AS statistic FROM (
          SELECT system, r, n, 0.5 + exp(-x * x / 2) / sqrt(2 * pi()) * s AS c FROM se WHERE i = 60) GROUP BY system, n),
        z AS (SELECT *, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * statistic AS v FROM ks)
        SELECT system, n, round(statistic, 6) AS statistic,
          round(CASE WHEN v < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, 2 * list_sum(list_transform(range(1, 101),
            lambda i: (CASE WHEN i % 2 = 1 THEN 1.0 ELSE -1.0 END) * exp(-2.0 * i * i * v * v))))) END, 6) AS p_value FROM z""",
)
def test_ks_systems(spark, d):
    """KS test of the per-query nDCG of all systems against N(0, 1) in one plan, p by the limiting distribution."""
    out = E.ks_normal_by(_ndcg(spark, d), "system", "ndcg", "query_id")
    return out.select("system", "n", F.round("statistic", 6).alias("statistic"), F.round("p_value", 6).alias("p_value"))


@register("test_ks_normal")
def test_ks_normal(spark, d):
    """KS test of the per-query nDCG of each system against N(0, 1)."""
    nd = materialize(_ndcg(spark, d))  # a row per system and query: MLlib's test reads it several times
    systems = sorted(r["system"] for r in nd.select("system").distinct().collect())
    out = None
    for s in systems or E.SYSTEMS:  # without an nDCG, a test of no values for each
        r = E.ks_normal(nd.where(F.col("system") == s), "ndcg").select(F.lit(s).alias("system"), "statistic", "pValue")
        out = r if out is None else out.unionByName(r)
    return out


KAPPA_SQL = f"""{Q.JUDG}, {PAIR_TF_SQL},
ann AS (SELECT query_id, label AS la, CASE WHEN tf >= 2 THEN 'E' WHEN tf = 1 THEN 'S' ELSE 'I' END AS lb FROM pt),
n AS (SELECT query_id, count(*) AS n, count_if(la = lb) AS agree FROM ann GROUP BY query_id),
ma AS (SELECT query_id, la AS l, count(*) AS ca FROM ann GROUP BY query_id, la),
mb AS (SELECT query_id, lb AS l, count(*) AS cb FROM ann GROUP BY query_id, lb),
pe AS (SELECT query_id, sum(ca * cb / (n * n)) AS pe FROM ma JOIN mb USING (query_id, l) JOIN n USING (query_id) GROUP BY query_id)"""


@register(
    "eval_cohen_kappa",
    f"""WITH {KAPPA_SQL} SELECT query_id, round(CASE WHEN coalesce(pe, 0.0) < 1.0
          THEN (agree / n - coalesce(pe, 0.0)) / (1.0 - coalesce(pe, 0.0)) END, 6) AS kappa
        FROM n LEFT JOIN pe USING (query_id)""",
)
def eval_cohen_kappa(spark, d):
    """Agreement per query between the judgments and a second annotator: labels assigned from the
    title/keyword overlap (tf >= 2 -> E, tf = 1 -> S, else I)."""
    pt = E.pair_tf(judgments(spark, d))
    lb = F.when(F.col("tf") >= 2, "E").when(F.col("tf") == 1, "S").otherwise("I")
    ann = pt.select("query_id", F.col("label").alias("label_a"), lb.alias("label_b"))
    return E.cohen_kappa(ann).select("query_id", F.round("kappa", 6).alias("kappa"))
