"""Ranking queries: TF, TF-IDF, BM25, BM25F and top-k over documents and part."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import prune as PR
from quarry.operators import rank as R
from quarry.plans import sql as Q
from quarry.plans.registry import register
from quarry.sources.tables import benchmark_queries, read_table, spread


def _docs(spark, d):
    return spread(read_table(spark, d, "documents").select("doc_id", "text"))


def _bench_sql(weight: str) -> str:
    return f"""WITH {Q.BENCH_Q}, {Q.DOC_TF}, {Q.DOC_STATS},
dfs AS (SELECT term, count(*) AS df FROM tfp WHERE term IN (SELECT term FROM bq) GROUP BY term),
hits AS (SELECT bq.query_id, bq.qpos, p.doc_id, {weight} AS w
         FROM tfp p JOIN bq USING (term) JOIN dfs USING (term) CROSS JOIN st),
sc AS (SELECT query_id, doc_id, {Q.unit_sum('w')} AS score FROM hits GROUP BY query_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id DESC) AS rank FROM sc)
SELECT query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10"""


def _bench(model):
    def run(spark, d):
        out = R.search(_docs(spark, d), "doc_id", "text", benchmark_queries(spark, d), k=10, model=model)
        return out.select("query_id", "rank", "doc_id", R.round_score())

    return run


register("rank_bm25", _bench_sql(f"{Q.bm25_w('p.tf', '1.2', '0.75', 'p.doc_len', 'st.avg_len')} * {Q.idf('st.n_docs', 'dfs.df')}"))(
    _bench("bm25")
)
register("rank_tfidf", _bench_sql(f"p.tf * {Q.idf('st.n_docs', 'dfs.df')}"))(_bench("tfidf"))
register("topk_batch", _bench_sql("p.tf::DOUBLE"))(_bench("tf"))


@register(
    "rank_bm25_pruned",
    _bench_sql(f"{Q.bm25_w('p.tf', '1.2', '0.75', 'p.doc_len', 'st.avg_len')} * {Q.idf('st.n_docs', 'dfs.df')}"),
)
def rank_bm25_pruned(spark, d):
    """rank_bm25 by thresholds: documents that cannot reach a query's best 10 are never scored."""
    return PR.search(_docs(spark, d), "doc_id", "text", benchmark_queries(spark, d)).select("query_id", "rank", "doc_id", R.round_score())


@register(
    "topk_own_k",
    _bench_sql(f"{Q.bm25_w('p.tf', '1.2', '0.75', 'p.doc_len', 'st.avg_len')} * {Q.idf('st.n_docs', 'dfs.df')}").replace("rank <= 10", "rank <= 1 + query_id % 10"),
)
def topk_own_k(spark, d):
    """BM25 with a number of results of each query's own: 1 to 10, by its id."""
    scored = R.best_scored(_docs(spark, d), "doc_id", "text", benchmark_queries(spark, d), 10, "bm25")
    own = scored.withColumn("k", 1 + F.col("query_id") % 10)
    return R.topk_batch(own, "query_id", 10, k_col="k").select("query_id", "rank", "doc_id", R.round_score())


# ---- single fixed queries (the reference's exercises) -----------------------------------------

from quarry.functions import scoring as S  # noqa: E402
from quarry.operators import match as M  # noqa: E402
from quarry.operators.util import one_row  # noqa: E402
from quarry.plans.match_plans import CLAUSE_SQL, clause_hits  # noqa: E402
from quarry.sources.tables import judgments, literal_queries  # noqa: E402

OF_THE = f"""{Q.DOC_TF}, {Q.DOC_STATS},
dfs AS (SELECT term, count(*) AS df FROM tfp WHERE term IN ('of', 'the') GROUP BY term),
q AS (SELECT 'of' AS term, 0 AS qpos UNION ALL SELECT 'the', 1)"""


@register(
    "topk",
    f"""WITH {OF_THE},
        sc AS (SELECT doc_id, {Q.unit_sum(Q.bm25_w('p.tf', '1.2', '0.75', 'p.doc_len', 'st.avg_len') + ' * ' + Q.idf('st.n_docs', 'dfs.df'))} AS score
               FROM tfp p JOIN q USING (term) JOIN dfs USING (term) CROSS JOIN st GROUP BY doc_id)
        SELECT row_number() OVER (ORDER BY score DESC, doc_id DESC) AS rank, doc_id, round(score, 6) AS score
        FROM sc ORDER BY score DESC, doc_id DESC LIMIT 10""",
)
def topk(spark, d):
    """One query {of, the}, BM25, global best 10 (TakeOrderedAndProject), ties to the larger id."""
    scored = R.score_queries(_docs(spark, d), "doc_id", "text", literal_queries(spark, {0: ["of", "the"]}), "bm25")
    return R.topk(scored, 10).select("rank", "doc_id", R.round_score())


@register(
    "rank_tf",
    f"""WITH {OF_THE},
        sc AS (SELECT doc_id, sum(tf) AS score FROM tfp WHERE term IN ('of', 'the') GROUP BY doc_id),
        r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id DESC) AS rank FROM sc)
        SELECT rank, doc_id, score::DOUBLE AS score FROM r WHERE rank <= 10""",
)
def rank_tf(spark, d):
    """Sum of tf over a two-term OR."""
    scored = R.score_queries(_docs(spark, d), "doc_id", "text", literal_queries(spark, {0: ["of", "the"]}), "tf")
    return R.topk(scored, 10).select("rank", "doc_id", "score")


@register(
    "rank_term_tf",
    f"""WITH {Q.DOC_TF}, r AS (SELECT doc_id, tf, row_number() OVER (ORDER BY tf DESC, doc_id DESC) AS rank
                               FROM tfp WHERE term = 'of')
        SELECT rank, doc_id, tf FROM r WHERE rank <= 10""",
)
def rank_term_tf(spark, d):
    postings = I.build_tf_postings(_docs(spark, d), "doc_id", "text")
    return R.topk(postings.where(F.col("term") == "of"), 10, score="tf").select("rank", "doc_id", "tf")


@register(
    "first_k_in_id_order",
    f"""WITH {Q.DOC_TF}, m AS (SELECT DISTINCT doc_id FROM tfp WHERE term IN ('The', 'was'))
        SELECT rank, doc_id, (SELECT count(*) FROM m) AS product_count
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM m) WHERE rank <= 10""",
)
def first_k_in_id_order(spark, d):
    """Unsorted Boolean result: the first 10 ids plus the total match count."""
    # one pass and no shuffle: a document's row knows whether it holds either term
    m = M.documents_with_any(_docs(spark, d), "doc_id", "text", ["The", "was"])
    total = m.agg(F.count(F.lit(1)).alias("product_count"))
    first = R.topk(m.withColumn("z", F.lit(0)), 10, score="z", ties="asc")
    return first.crossJoin(one_row(total)).select("rank", "doc_id", "product_count")


@register(
    "rank_tf_positional",
    f"""WITH {CLAUSE_SQL},
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, doc_id DESC) AS rank,
                     count(*) OVER (PARTITION BY query_id) AS product_count FROM cl)
        SELECT query_id, rank, doc_id, tf, product_count FROM r WHERE rank <= 10""",
)
def rank_tf_positional(spark, d):
    """Clause queries sorted by summed occurrences of matched leaves: top 10 + total count."""
    hits = clause_hits(spark, d)
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("product_count"))
    top = R.topk_batch(hits, "query_id", 10, score="tf")
    return top.join(counts, "query_id").select("query_id", "rank", "doc_id", "tf", "product_count")


@register(
    "score_idf",
    f"WITH {Q.DOC_TF}, {Q.DOC_STATS} SELECT term, df, round({Q.idf('n_docs', 'df')}, 6) AS idf "
    "FROM (SELECT term, count(*) AS df FROM tfp GROUP BY term) CROSS JOIN st",
)
def score_idf(spark, d):
    docs = _docs(spark, d)
    dfs = I.term_df(I.build_postings(docs, "doc_id", "text"))
    stats = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    return dfs.crossJoin(one_row(stats)).select("term", "df", F.round(S.idf("n_docs", "df"), 6).alias("idf"))


@register(
    "score_bm25_weight",
    f"WITH {Q.DOC_TF}, {Q.DOC_STATS} SELECT doc_id, round({Q.bm25_w('tf', '1.2', '0.75', 'doc_len', 'avg_len')}, 6) AS w "
    "FROM tfp CROSS JOIN st WHERE term = 'of'",
)
def score_bm25_weight(spark, d):
    matching = I.matching_counts(_docs(spark, d), "doc_id", "text", literal_queries(spark, {0: ["of"]}))
    _, stats = I.matching_stats(matching)
    w = S.bm25_weight("tf", 1.2, 0.75, "doc_len", "avg_len")
    return matching.where(F.col("term") == "of").crossJoin(one_row(stats)).select("doc_id", F.round(w, 6).alias("w"))


@register(
    "score_bm25f_weight",
    f"WITH {Q.DOC_TF}, {Q.DOC_STATS} SELECT doc_id, round({Q.bm25f_w('tf', '2.0', '0.75', 'doc_len', 'avg_len')}, 6) AS w "
    "FROM tfp CROSS JOIN st WHERE term = 'of'",
)
def score_bm25f_weight(spark, d):
    matching = I.matching_counts(_docs(spark, d), "doc_id", "text", literal_queries(spark, {0: ["of"]}))
    _, stats = I.matching_stats(matching)
    w = S.bm25f_weight("tf", 2.0, 0.75, "doc_len", "avg_len")
    return matching.where(F.col("term") == "of").crossJoin(one_row(stats)).select("doc_id", F.round(w, 6).alias("w"))


# ---- BM25F over part: title = p_name, keyword field = p_brand ----------------------------------

# Title terms and brand of the two BM25F queries (stand-ins for HDMI, Cable, Amazon Basics).
BM25F_QUERIES = {1: (["red", "bolt"], "Brand#4"), 2: (["hot", "plate"], "Brand#12")}


def bm25f_rank(spark, d, k1_values):
    from quarry.operators.rank import bm25f_search

    part = read_table(spark, d, "part")
    qt = literal_queries(spark, {q: t for q, (t, _) in BM25F_QUERIES.items()})
    qb = spark.createDataFrame([(q, b) for q, (_, b) in BM25F_QUERIES.items()], "query_id bigint, brand string")
    params = spark.createDataFrame([(float(k),) for k in k1_values], "k1 double")
    return bm25f_search(part, "p_partkey", "p_name", "p_brand", qt, qb, params, k=10)


def _bm25f_sql(k1s):
    ks = " UNION ALL ".join(f"SELECT {k}::DOUBLE AS k1" for k in k1s)
    qt = " UNION ALL ".join(
        f"SELECT {q} AS query_id, {i} AS qpos, '{t}' AS term" for q, (ts, _) in BM25F_QUERIES.items() for i, t in enumerate(ts)
    )
    qb = " UNION ALL ".join(f"SELECT {q} AS query_id, '{b}' AS brand" for q, (_, b) in BM25F_QUERIES.items())
    wt = Q.bm25f_w("p.tf", "2.0", "0.75", "p.doc_len", "st.avg_len")
    wb = Q.bm25f_w("(CASE WHEN d.p_brand = qb.brand THEN 1 ELSE 0 END)", "1.0", "0.75", "1", "1")
    return f"""WITH params AS ({ks}), qt AS ({qt}), qb AS ({qb}),
tok AS (SELECT p_partkey AS doc_id, string_split_regex(p_name, '\\s+') AS t FROM part WHERE p_name IS NOT NULL),
p AS (SELECT term, doc_id, count(*) AS tf, any_value(doc_len) AS doc_len
      FROM (SELECT doc_id, len(t) AS doc_len, unnest(t) AS term FROM tok) GROUP BY term, doc_id),
st AS (SELECT count(*) AS n_docs, avg(coalesce(len(string_split_regex(p_name, '\\s+')), 0)::DOUBLE) AS avg_len FROM part),
dft AS (SELECT term, count(*) AS df FROM p GROUP BY term),
dfb AS (SELECT qb.query_id, count(d.p_partkey) AS df FROM qb LEFT JOIN part d ON d.p_brand = qb.brand GROUP BY qb.query_id),
th AS (SELECT params.k1, qt.query_id, p.doc_id, qt.qpos, {wt} AS w, {Q.idf('st.n_docs', 'dft.df')} AS idf
       FROM p JOIN qt USING (term) JOIN dft USING (term) CROSS JOIN st CROSS JOIN params),
ts AS (SELECT k1, query_id, doc_id, sum(CAST(round(w / (k1 + w) * idf * 1e9) AS BIGINT)) AS s FROM th GROUP BY k1, query_id, doc_id),
sc AS (SELECT ts.k1, ts.query_id, ts.doc_id,
              (ts.s + CAST(round(({wb}) / (ts.k1 + ({wb})) * {Q.idf('st.n_docs', 'dfb.df')} * 1e9) AS BIGINT)) / 1e9 AS score
       FROM ts JOIN part d ON d.p_partkey = ts.doc_id JOIN qb ON qb.query_id = ts.query_id
       JOIN dfb ON dfb.query_id = ts.query_id CROSS JOIN st),
r AS (SELECT *, row_number() OVER (PARTITION BY k1, query_id ORDER BY score DESC, doc_id DESC) AS rank FROM sc)
SELECT k1, query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10"""


@register("rank_bm25f", _bm25f_sql([1.2]))
def rank_bm25f(spark, d):
    return bm25f_rank(spark, d, [1.2])


@register("rank_bm25f_sweep", _bm25f_sql([1.2, 3.5]))
def rank_bm25f_sweep(spark, d):
    """The same ranking for K1 in {1.2, 3.5} in one job (parameter table cross join)."""
    return bm25f_rank(spark, d, [1.2, 3.5])


# ---- judged-pair rankings (evaluation systems) -------------------------------------------------


@register(
    "order_baseline",
    f"WITH {Q.JUDG} SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS rank FROM judg",
)
def order_baseline(spark, d):
    from quarry.operators.evaluate import system_baseline

    return system_baseline(judgments(spark, d)).select("query_id", "doc_id", "rank")


PAIR_TF_SQL = f"""pt AS (SELECT query_id, doc_id, label,
       len(list_filter({Q.ws('title')}, lambda x: list_contains({Q.ws('query')}, x))) AS tf FROM judg)"""


@register("pair_tf", f"WITH {Q.JUDG}, {PAIR_TF_SQL} SELECT query_id, doc_id, tf FROM pt")
def pair_tf(spark, d):
    from quarry.operators.evaluate import pair_tf as ptf

    return ptf(judgments(spark, d)).select("query_id", "doc_id", "tf")


PAIR_TFIDF_SQL = f"""tdf AS (SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest({Q.ws('text')}) AS term FROM documents) GROUP BY term),
nn AS (SELECT count(*) AS n FROM documents),
ttf AS (SELECT query_id, doc_id, term, count(*) AS tf FROM (SELECT query_id, doc_id, unnest({Q.ws('title')}) AS term FROM judg)
        GROUP BY query_id, doc_id, term),
kw AS (SELECT DISTINCT item_id AS query_id, unnest({Q.ws('text')}) AS term FROM benchmark),
con AS (SELECT ttf.query_id, ttf.doc_id, ttf.tf * {Q.idf('nn.n', 'tdf.df')} AS c
        FROM ttf JOIN kw USING (query_id, term) JOIN tdf USING (term) CROSS JOIN nn),
cs AS (SELECT query_id, doc_id, {Q.unit_sum('c')} AS s FROM con GROUP BY query_id, doc_id),
ptf AS (SELECT j.query_id, j.doc_id, j.label, coalesce(cs.s, 0.0) AS tfidf FROM judg j LEFT JOIN cs USING (query_id, doc_id))"""


@register("pair_tfidf", f"WITH {Q.JUDG}, {PAIR_TFIDF_SQL} SELECT query_id, doc_id, round(tfidf, 6) AS tfidf FROM ptf")
def pair_tfidf(spark, d):
    from quarry.operators.evaluate import pair_tfidf as ptfidf

    docs = read_table(spark, d, "documents")
    return ptfidf(judgments(spark, d), docs).select("query_id", "doc_id", F.round("tfidf", 6).alias("tfidf"))


@register(
    "order_by_score",
    f"""WITH {Q.JUDG}, {PAIR_TF_SQL}
        SELECT query_id, doc_id, tf, row_number() OVER (PARTITION BY query_id ORDER BY tf DESC, doc_id ASC) AS rank FROM pt""",
)
def order_by_score(spark, d):
    from quarry.operators.evaluate import pair_tf as ptf

    ranked = R.rank_all(ptf(judgments(spark, d)), "query_id", "tf", "doc_id", ties="asc")
    return ranked.select("query_id", "doc_id", "tf", "rank")
