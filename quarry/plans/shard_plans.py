"""Sharded search renderings over the documents index."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import index as I
from quarry.operators import lifecycle as L
from quarry.operators import rank as R
from quarry.operators import shard as SH
from quarry.plans import sql as Q
from quarry.plans.rank_plans import _bench_sql, _docs
from quarry.plans.registry import register
from quarry.sources.tables import benchmark_queries, read_table

N_SHARDS = 4
BM25_W = f"{Q.bm25_w('p.tf', '1.2', '0.75', 'p.doc_len', 'st.avg_len')} * {Q.idf('st.n_docs', 'dfs.df')}"


@register(
    "shard_assign",
    f"SELECT {Q.md5_mod('CAST(doc_id AS VARCHAR)', N_SHARDS)}::INTEGER AS shard, count(*) AS n_docs FROM documents GROUP BY shard",
)
def shard_assign(spark, d):
    return SH.shard_counts(read_table(spark, d, "documents"), "doc_id", N_SHARDS)


@register("sharded_topk", _bench_sql(BM25_W))
def sharded_topk(spark, d):
    """BM25 with global statistics, top 10 per (shard, query) then per query: equals rank_bm25."""
    # a document's shard is found once and travels in its key, not once per query that it matches
    docs = SH.assign_shard(_docs(spark, d), "doc_id", N_SHARDS).select(F.struct("shard", "doc_id").alias("key"), "text")
    scored = R.best_scored(docs, "key", "text", benchmark_queries(spark, d), 10, "bm25", part="shard")
    top = SH.sharded_topk(scored, 10)
    return top.select("query_id", "rank", "doc_id", R.round_score())


@register(
    "two_stage_topk",
    _bench_sql(BM25_W).replace(
        "SELECT query_id, rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10",
        f"""SELECT r.query_id, r.rank, r.doc_id, round(r.score, 6) AS score,
                   d.text AS title
            FROM r JOIN documents d USING (doc_id) WHERE r.rank <= 10""",
    ),
)
def two_stage_topk(spark, d):
    """Rank on narrow postings first, then fetch the title only for the 10 winners per query."""
    top = R.search(_docs(spark, d), "doc_id", "text", benchmark_queries(spark, d), k=10, model="bm25")
    docs = read_table(spark, d, "documents")
    out = SH.late_materialize(top, docs, "doc_id", {"title": F.col("text")})
    return out.select("query_id", "rank", "doc_id", R.round_score(), "title")


@register(
    "shard_split",
    f"""SELECT {Q.md5_mod('CAST(doc_id AS VARCHAR)', 2)}::INTEGER AS old_shard,
               {Q.md5_mod('CAST(doc_id AS VARCHAR)', 4)}::INTEGER AS new_shard, count(*) AS n_docs
        FROM documents GROUP BY old_shard, new_shard""",
)
def shard_split(spark, d):
    return SH.split_shards(read_table(spark, d, "documents"), "doc_id", 2)


@register(
    "shard_vocabulary_union",
    f"""SELECT DISTINCT term FROM (SELECT unnest({Q.ws('text')}) AS term FROM documents WHERE text IS NOT NULL)
        WHERE {Q.md5_mod('term', 100)} = 0""",
)
def shard_vocabulary_union(spark, d):
    """Sorted union of each shard's ~1 % vocabulary sample (per-shard distinct, then union)."""
    # the sample is a predicate on the term, so it is taken before anything moves
    sample = I.build_postings(_docs(spark, d), "doc_id", "text").where(L.in_hash_sample("term"))
    per_shard = SH.assign_shard(sample, "doc_id", N_SHARDS).select("shard", "term").distinct()
    return per_shard.select("term").distinct()
