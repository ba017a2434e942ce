"""Relevance evaluation: rankings of judged pairs, metrics and significance tests.

A ranking table is (system, query_id, doc_id, label, rank) with rank 1 = best. Metrics at a
cutoff only touch rows with rank <= k and are plain aggregates (partial aggregation, no
per-query sort). Mean average precision needs the running count of relevant rows, a window
over each query's full list.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import distributions as D
from quarry.functions import scoring as S
from quarry.functions.text import tok_whitespace
from quarry.operators import rank as R
from quarry.operators.index import let, term_counts
from quarry.operators.util import one_row


def system_baseline(j: DataFrame) -> DataFrame:
    """Baseline ranking: by doc_id within each query."""
    return R.rank_all(j.withColumn("score", F.lit(0)), "query_id", "score", "doc_id", ties="asc").drop("score")


def pair_tf(j: DataFrame) -> DataFrame:
    """Title tokens that are among the query keywords (keyword set semantics)."""
    held = let(tok_whitespace("query"), lambda kw: F.filter(tok_whitespace("title"), lambda x: F.array_contains(kw, x)))
    return j.withColumn("tf", F.size(held).cast("bigint"))


def keyword_df(docs: DataFrame, keywords: DataFrame, text_col: str = "text") -> DataFrame:
    """(term, df) over the documents, of the terms of ``keywords`` only."""
    terms = docs.select(F.explode(F.array_distinct(tok_whitespace(text_col))).alias("term"))
    return terms.join(keywords.select("term").distinct(), "term").groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def pair_tfidf(j: DataFrame, docs: DataFrame) -> DataFrame:
    """Sum over the distinct query keywords in the title of tf * idf; pairs without any get 0.

    The keywords of a title are counted within its row, so one (pair, keyword) row each meets the
    document frequencies, and sums of whole billionths make ties exact."""
    kw = F.array_distinct(tok_whitespace("query"))
    held = let(kw, lambda k: F.filter(term_counts(tok_whitespace("title")), lambda x: F.array_contains(k, x["term"])))
    hits = j.select("query_id", "doc_id", F.explode(held).alias("c"))
    keywords = j.select("query_id", "query").distinct().select(F.explode(kw).alias("term"))
    n = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    con = hits.select("query_id", "doc_id", "c.term", "c.tf").join(keyword_df(docs, keywords), "term").crossJoin(one_row(n))
    s = con.groupBy("query_id", "doc_id").agg(F.sum(R.units(F.col("tf") * S.idf("n_docs", "df"))).alias("s"))
    out = j.join(s, ["query_id", "doc_id"], "left")
    return out.withColumn("tfidf", F.coalesce(R.in_units(F.col("s")), F.lit(0.0))).drop("s")


SYSTEMS = ("baseline", "tf", "tfidf")


def system_scores(j: DataFrame, docs: DataFrame) -> DataFrame:
    """(system, query_id, doc_id, label, score) of the three ``SYSTEMS`` over the judged pairs: baseline (all
    0, so in id order), tf and tfidf. One row per pair is scored, then unfolded."""
    scored = pair_tfidf(pair_tf(j), docs)
    scores = (F.lit(0.0), F.col("tf"), F.col("tfidf"))
    systems = F.array(*[F.struct(F.lit(n).alias("system"), c.cast("double").alias("score")) for n, c in zip(SYSTEMS, scores)])
    return scored.select("query_id", "doc_id", "label", F.explode(systems).alias("s")).select("s.system", "query_id", "doc_id", "label", "s.score")


def system_rankings(j: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` per system and query (ties: smaller id): partial top-k before the shuffle."""
    return R.topk_batch(system_scores(j, docs), ["system", "query_id"], k, ties="asc").drop("score")


def ideal_ranking(j: DataFrame, k: int | None = None) -> DataFrame:
    """Judged pairs ordered by gain desc, doc_id asc (top k only when k is given)."""
    g = j.withColumn("gain", S.label_gain("label"))
    if k is None:
        return R.rank_all(g, "query_id", "gain", "doc_id", ties="asc")
    return R.topk_batch(g, "query_id", k, score="gain", ties="asc")


def precision_at_k(r: DataFrame, k: int, keys=("system",)) -> DataFrame:
    """Mean over queries of relevant/min(k, list length) among the top k."""
    per_q = (
        r.where(F.col("rank") <= k)
        .groupBy(*keys, "query_id")
        .agg((F.sum(S.is_relevant("label")) / F.count(F.lit(1))).alias("p"))
    )
    return per_q.groupBy(*keys).agg(F.avg("p").alias(f"p_at_{k}"))


def average_precision(scored: DataFrame, keys=("system",)) -> DataFrame:
    """AP per query over queries with at least one relevant row, from scored pairs. Ranks and running
    counts of relevant rows come from one skew-safe pass (a hot query spans partitions)."""
    rel = scored.withColumn("rel", S.is_relevant("label"))
    cum = R.rank_within(rel, [*keys, "query_id"], "score", "doc_id", running="rel")
    return (
        cum.groupBy(*keys, "query_id")
        .agg(F.sum(F.when(F.col("rel") == 1, F.col("running_rel") / F.col("rank"))).alias("s"), F.sum("rel").alias("n_rel"))
        .where(F.col("n_rel") > 0)
        .select(*keys, "query_id", (F.col("s") / F.col("n_rel")).alias("ap"))
    )


def mean_average_precision(scored: DataFrame, keys=("system",)) -> DataFrame:
    return average_precision(scored, keys).groupBy(*keys).agg(F.avg("ap").alias("map"))


def dcg_at_k(r: DataFrame, k: int, keys=("system",)) -> DataFrame:
    """Per query sum of gain/log2(rank+1) over rank <= k (linear gain).

    Added in rank order (one conditional sum per rank), so two systems with the same top-k gains
    get bit-identical DCG and a tie stays a tie in the sign test."""
    contrib = S.label_gain("label") / F.log2(F.col("rank") + 1)
    parts = [F.sum(F.when(F.col("rank") == i, contrib)).alias(f"_c{i}") for i in range(1, k + 1)]
    total = F.lit(0.0)
    for i in range(1, k + 1):
        total = total + F.coalesce(F.col(f"_c{i}"), F.lit(0.0))
    return r.where(F.col("rank") <= k).groupBy(*keys, "query_id").agg(*parts).select(*keys, "query_id", total.alias("dcg"))


def ideal_dcg_at_k(j: DataFrame, k: int) -> DataFrame:
    ideal = ideal_ranking(j, k).withColumn("system", F.lit("ideal"))
    return dcg_at_k(ideal, k).select("query_id", F.col("dcg").alias("ideal_dcg"))


def ndcg_at_k(r: DataFrame, j: DataFrame, k: int, keys=("system",)) -> DataFrame:
    """DCG / ideal DCG, dropping queries whose ideal DCG is 0."""
    ideal = ideal_dcg_at_k(j, k)
    return (
        dcg_at_k(r, k, keys)
        .join(ideal, "query_id")
        .where(F.col("ideal_dcg") > 0)
        .select(*keys, "query_id", (F.col("dcg") / F.col("ideal_dcg")).alias("ndcg"))
    )


def paired(metric: DataFrame, a: str, b: str, value: str = "ndcg") -> DataFrame:
    """(query_id, a, b) metric values of two systems on the same queries."""
    return (
        metric.where(F.col("system").isin(a, b))
        .groupBy("query_id")
        .agg(F.max(F.when(F.col("system") == a, F.col(value))).alias("a"), F.max(F.when(F.col("system") == b, F.col(value))).alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull())
    )


def sign_counts(pairs: DataFrame) -> DataFrame:
    """Wins of a (a > b) and of b (b > a); ties ignored."""
    return pairs.agg(
        F.count_if(F.col("a") > F.col("b")).cast("bigint").alias("a_wins"),
        F.count_if(F.col("b") > F.col("a")).cast("bigint").alias("b_wins"),
    )


@F.pandas_udf(T.DoubleType())
def _binom_p(k: pd.Series, n: pd.Series) -> pd.Series:
    from quarry.functions.stats import binom_two_sided_p_half

    return pd.Series([binom_two_sided_p_half(int(a), int(b)) for a, b in zip(k, n)], dtype="float64")


def binomial_sign_test(pairs: DataFrame) -> DataFrame:
    """Two-sided exact binomial test (p = 0.5) on the wins of b among non-tied queries."""
    c = sign_counts(pairs)
    return c.select("a_wins", "b_wins", _binom_p(F.col("b_wins"), F.col("a_wins") + F.col("b_wins")).alias("p_value"))


def _t_columns(d: Column) -> list[Column]:
    n = F.count(F.lit(1))
    return [n.alias("n"), F.avg(d).alias("mean_diff"), (F.avg(d) / (F.stddev_samp(d) / F.sqrt(n))).alias("t")]


def paired_t(pairs: DataFrame) -> DataFrame:
    """Paired t statistic of a - b (a: the improved system)."""
    return pairs.agg(*_t_columns(F.col("a") - F.col("b")))


def paired_t_by_pair(metric: DataFrame, value: str = "ndcg") -> DataFrame:
    """(system_a, system_b, n, mean_diff, t) for all pairs of systems, the later name minus the earlier:
    one self-join on the query (each query meets itself once per system)."""
    a = metric.select("query_id", F.col("system").alias("system_a"), F.col(value).alias("a"))
    b = metric.select("query_id", F.col("system").alias("system_b"), F.col(value).alias("b"))
    both = a.join(b, "query_id").where(F.col("system_a") > F.col("system_b"))
    return both.groupBy("system_a", "system_b").agg(*_t_columns(F.col("a") - F.col("b")))


def with_t_p_value(t: DataFrame) -> DataFrame:
    return t.withColumn("p_value", D.t_two_sided(F.col("t"), F.col("n") - 1))


def paired_t_test(pairs: DataFrame) -> DataFrame:
    return with_t_p_value(paired_t(pairs))


def bonferroni(p, m: int):
    """p * m(m-1)/2 over all pairs of m systems, not clamped."""
    return p * F.lit(m * (m - 1) / 2.0)


def ks_normal(values: DataFrame, col: str) -> DataFrame:
    """One-sample Kolmogorov-Smirnov test against N(0, 1), without standardisation."""
    from pyspark.ml.stat import KolmogorovSmirnovTest

    return KolmogorovSmirnovTest.test(values.select(F.col(col).cast("double").alias(col)), col, "norm", 0.0, 1.0)


def ks_normal_by(values: DataFrame, group: str, col: str, id_col: str) -> DataFrame:
    """(group, n, statistic, p_value) of the same test for every group at once, p by the limiting
    distribution. The empirical distribution comes from one skew-safe rank; of equal values the last rank
    counts from above and the first from below, which the greatest difference takes by itself."""
    x = values.select(group, F.col(id_col), F.col(col).cast("double").alias("x")).where("x IS NOT NULL")
    n = x.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    ranked = R.rank_within(x.withColumn("_down", -F.col("x")), group, "_down", id_col).join(n, group)
    cdf = ranked.select(group, "n", "rank", D.normal_cdf(F.col("x")).alias("c"))
    gap = F.greatest(F.col("rank") / F.col("n") - F.col("c"), F.col("c") - (F.col("rank") - 1) / F.col("n"))
    out = cdf.groupBy(group).agg(F.max("n").alias("n"), F.max(gap).alias("statistic"))
    return out.withColumn("p_value", D.kolmogorov_p(F.col("statistic"), F.col("n")))


def cohen_kappa(labels: DataFrame, a: str = "label_a", b: str = "label_b", group: str = "query_id") -> DataFrame:
    """Per group (p_o - p_e) / (1 - p_e) from a confusion aggregate; null when p_e = 1."""
    n = labels.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(a) == F.col(b)).alias("agree"))
    ma = labels.groupBy(group, F.col(a).alias("l")).agg(F.count(F.lit(1)).alias("ca"))
    mb = labels.groupBy(group, F.col(b).alias("l")).agg(F.count(F.lit(1)).alias("cb"))
    pe = ma.join(mb, [group, "l"]).join(n, group).groupBy(group).agg(F.sum(F.col("ca") * F.col("cb") / (F.col("n") * F.col("n"))).alias("pe"))
    out = n.join(pe, group, "left").withColumn("pe", F.coalesce("pe", F.lit(0.0))).withColumn("po", F.col("agree") / F.col("n"))
    return out.select(group, F.when(F.col("pe") < 1.0, (F.col("po") - F.col("pe")) / (1.0 - F.col("pe"))).alias("kappa"))
