"""Top-k search that leaves out what cannot reach a query's best k.

Every term has a largest contribution to any document. Once some k documents of a query are scored, the k-th
of them is a threshold: a document that holds only terms whose largest contributions add up to less can't
reach it. So a query's commonest terms (stop words, mostly) select nothing: documents come from the other
terms' postings, are kept if their score there plus all that the common terms could add reaches the
threshold, and only then meet the common terms. The result is that of scoring every pair.

Scores are sums of whole billionths (see ``rank``), so bounds and ties are exact. Contributions may be
negative (a term in over half the documents); as a bound they count as 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions import scoring as S
from quarry.operators import index as I
from quarry.operators import rank as R
from quarry.operators.util import one_row, stored

FIRST = 8  # documents scored for the threshold: at least so many times k postings, of the rarest terms


def contributions(docs: DataFrame, id_col: str, text_col: str, queries: DataFrame) -> DataFrame:
    """(term, doc_id, u): BM25 of every posting of a query term, in whole billionths; written once."""
    matching = I.matching_counts(docs, id_col, text_col, queries)
    dfs, corpus = I.matching_stats(matching)
    hits = matching.where("term <> ''").join(dfs, "term").crossJoin(one_row(corpus))
    w = S.bm25_weight(F.col("tf"), F.lit(S.BM25_K1), F.lit(S.BM25_B), F.col("doc_len"), F.col("avg_len")) * S.idf(F.col("n_docs"), F.col("df"))
    return stored(hits.select("term", "doc_id", R.units(w).alias("u")), "contributions")


def query_terms(queries: DataFrame, postings: DataFrame) -> DataFrame:
    """(query_id, term, times, df, most): how often the query has the term, and the term's largest
    contribution, at least 0, times that."""
    bounds = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.greatest(F.max("u"), F.lit(0)).alias("ub"))
    q = queries.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("times"))
    return q.join(bounds, "term").select("query_id", "term", "times", "df", (F.col("times") * F.col("ub")).alias("most"))


def thresholds(postings: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """(query_id, least): the k-th best score among the documents of the query's rarest terms, taken until
    they have ``FIRST`` * k postings; null with fewer than k documents."""
    before = Window.partitionBy("query_id").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    rare = terms.withColumn("_b", F.coalesce(F.sum("df").over(before), F.lit(0))).where(F.col("_b") < FIRST * k)
    some = postings.join(rare.select("query_id", "term"), "term").select("query_id", "doc_id").distinct()
    scored = _scored(some, postings, terms)
    kth = R.topk_batch(scored, "query_id", k, score="s").where(F.col("rank") == k).select("query_id", F.col("s").alias("least"))
    return terms.select("query_id").distinct().join(kth, "query_id", "left")


def _scored(pairs: DataFrame, postings: DataFrame, terms: DataFrame) -> DataFrame:
    """(query_id, doc_id, s) of the given pairs over the given terms."""
    met = pairs.select("query_id", "doc_id").join(postings, "doc_id").join(terms.select("query_id", "term", "times"), ["query_id", "term"])
    return met.groupBy("query_id", "doc_id").agg(F.sum(F.col("times") * F.col("u")).alias("s"))


def survivors(postings: DataFrame, terms: DataFrame, least: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs that may reach their query's threshold with their score over its selecting terms, the other
    terms)."""
    upto = Window.partitionBy("query_id").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
    split = terms.join(least, "query_id").withColumn("sum", F.sum("most").over(upto))
    split = split.withColumn("common", F.coalesce(F.col("sum") < F.col("least"), F.lit(False)))
    slack = split.groupBy("query_id").agg(F.sum(F.when(F.col("common"), F.col("most")).otherwise(0)).alias("slack"), F.max("least").alias("least"))
    picks = split.where(~F.col("common")).select("query_id", "term", "times")
    part = postings.join(picks, "term").groupBy("query_id", "doc_id").agg(F.sum(F.col("times") * F.col("u")).alias("s"))
    kept = part.join(slack, "query_id").where(F.col("least").isNull() | (F.col("s") + F.col("slack") >= F.col("least")))
    return kept.select("query_id", "doc_id", "s"), split.where("common").select("query_id", "term", "times")


def search(docs: DataFrame, id_col: str, text_col: str, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, doc_id, score): the best k by BM25, ties to the larger id."""
    postings = contributions(docs, id_col, text_col, queries)
    terms = stored(query_terms(queries, postings), "query-terms")
    kept, common = survivors(postings, terms, stored(thresholds(postings, terms, k), "thresholds"))
    kept = stored(kept, "survivors")
    rest = _scored(kept, postings, common).withColumnRenamed("s", "more")
    total = kept.join(rest, ["query_id", "doc_id"], "left").withColumn("score", R.in_units(F.col("s") + F.coalesce("more", F.lit(0))))
    return R.topk_batch(total, "query_id", k).select("query_id", "rank", "doc_id", "score")
