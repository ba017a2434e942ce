"""Pruned search against the search that scores every pair, and how much it leaves out."""

import random

from pyspark.sql import functions as F

from conftest import SF01
from quarry.operators import prune as PR
from quarry.operators import rank as R
from quarry.sources.tables import benchmark_queries, read_table


def _same(a, b):
    key = lambda r: (r.query_id, r.rank, r.doc_id, round(r.score, 9))
    return sorted(map(key, a.collect())) == sorted(map(key, b.collect()))


def test_equals_search_with_ties_negative_terms_and_few_matches(spark):
    rng = random.Random(2)
    words = ["the"] * 40 + ["of"] * 25 + [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(300)] + [(300, None), (301, "w1 w1"), (302, "w1 w1")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    asked = {1: "the of w1 w2 w2", 2: "the", 3: "of the the", 4: "w3 absent", 5: "absent", 6: " ".join(f"w{i}" for i in range(12)) + " the of"}
    queries = spark.createDataFrame([(q, t, n) for q, text in asked.items() for n, t in enumerate(text.split())], "query_id long, term string, qpos int")
    for k in (1, 10, 1000):
        assert _same(PR.search(docs, "doc_id", "text", queries, k), R.search(docs, "doc_id", "text", queries, k))


def test_scores_few_of_the_pairs(spark):
    docs, queries = read_table(spark, SF01, "documents").select("doc_id", "text"), benchmark_queries(spark, SF01)
    postings = PR.contributions(docs, "doc_id", "text", queries)
    terms = PR.query_terms(queries, postings)
    kept, common = PR.survivors(postings, terms, PR.thresholds(postings, terms, 10))
    pairs = R.score_queries(docs, "doc_id", "text", queries).count()
    n = kept.count()
    assert n < pairs / 2 and common.count() > 0
    picked = terms.join(common, ["query_id", "term"], "left_anti")
    rows = picked.agg(F.sum("df")).first()[0]  # postings that meet a query
    assert rows < terms.agg(F.sum("df")).first()[0] / 2
