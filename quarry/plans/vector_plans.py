"""Vector search queries over ``embeddings``.

Query vectors are the per-label mean embeddings (one query per label), so the query batch is
derived from the data. k = 10; centroids = floor(sqrt(n)).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import annindex as AX
from quarry.operators import lsa as LSA
from quarry.operators import vector as V
from quarry.functions import vectors as VF
from quarry.operators import rank as R
from quarry.plans import sql as Q
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.tables import read_table, spread

K = 10


def _dot(a: str, b: str) -> str:
    return f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: {a}[i]::DOUBLE * {b}[i]::DOUBLE), lambda x, y: x + y)"


def _sqd(a: str, b: str) -> str:
    return (
        f"list_reduce(list_transform(range(1, len({a}) + 1), lambda i: ({a}[i]::DOUBLE - {b}[i]::DOUBLE) * "
        f"({a}[i]::DOUBLE - {b}[i]::DOUBLE)), lambda x, y: x + y)"
    )


QV_SQL = """qv AS (SELECT label AS query_id, list(v ORDER BY i) AS qv FROM (
  SELECT label, i, avg(e::DOUBLE) AS v FROM (SELECT label, unnest(range(len(embedding))) AS i, unnest(embedding) AS e FROM embeddings)
  GROUP BY label, i) GROUP BY label)"""

EXACT_SQL = f"""{QV_SQL},
ds AS (SELECT q.query_id, e.vec_id, {_dot('e.embedding', 'q.qv')} AS score FROM embeddings e CROSS JOIN qv q),
ex AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id DESC) AS rank FROM ds)
       WHERE rank <= {K})"""

CENT_SQL = """cen AS (SELECT centroid_id, vec_id, embedding AS cv FROM (
  SELECT row_number() OVER (ORDER BY md5(vec_id::VARCHAR)) - 1 AS centroid_id, vec_id, embedding FROM embeddings)
  WHERE centroid_id < (SELECT floor(sqrt(count(*))) FROM embeddings))"""


def _ivf_sql(probes: list[int]) -> str:
    ps = " UNION ALL ".join(f"SELECT {p} AS n_probe" for p in probes)
    return f"""{EXACT_SQL}, {CENT_SQL}, np AS ({ps}),
asg AS (SELECT n_probe, vec_id, centroid_id FROM (
  SELECT np.n_probe, e.vec_id, c.centroid_id,
         row_number() OVER (PARTITION BY np.n_probe, e.vec_id ORDER BY {_sqd('e.embedding', 'c.cv')}, c.centroid_id) AS r
  FROM embeddings e CROSS JOIN cen c CROSS JOIN np) WHERE r <= n_probe),
prb AS (SELECT n_probe, query_id, centroid_id FROM (
  SELECT np.n_probe, q.query_id, c.centroid_id,
         row_number() OVER (PARTITION BY np.n_probe, q.query_id ORDER BY {_sqd('q.qv', 'c.cv')}, c.centroid_id) AS r
  FROM qv q CROSS JOIN cen c CROSS JOIN np) WHERE r <= n_probe),
cand AS (SELECT DISTINCT prb.n_probe, prb.query_id, asg.vec_id FROM prb JOIN asg USING (n_probe, centroid_id)),
sc AS (SELECT cand.n_probe, cand.query_id, cand.vec_id, {_dot('e.embedding', 'q.qv')} AS score
       FROM cand JOIN embeddings e USING (vec_id) JOIN qv q USING (query_id)),
ap AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY n_probe, query_id ORDER BY score DESC, vec_id DESC) AS rank FROM sc)
       WHERE rank <= {K})"""


def _emb(spark, d):
    return read_table(spark, d, "embeddings")


def _queries(spark, d):
    """Per-label mean vectors, checkpointed: computed once, then read in blocks."""
    from quarry.operators.util import materialize

    q = V.mean_vectors(_emb(spark, d), "label").withColumnRenamed("label", "query_id")
    return materialize(q.withColumn("query_id", F.col("query_id").cast("bigint")))


def _centroids(spark, d):
    e = _emb(spark, d)
    from quarry.operators.util import materialize

    m = V.n_centroids(e.count())
    return materialize(V.sample_centroids(e, m))


def _ivf(spark, d, probes):
    e, q, cen = _emb(spark, d), _queries(spark, d), _centroids(spark, d)
    return V.ivf_search(e, q, cen, V.ivf_assign(e, cen, max(probes)), probes, K)


@register(
    "vec_passthrough",
    f"SELECT vec_id, len(embedding) AS dim, round(sqrt({_dot('embedding', 'embedding')}), 6) AS norm FROM embeddings",
)
def vec_passthrough(spark, d):
    e = _emb(spark, d)
    return e.select("vec_id", F.size("embedding").cast("bigint").alias("dim"), F.round(VF.norm("embedding"), 6).alias("norm"))


@register("vec_dot", f"WITH {EXACT_SQL} SELECT query_id, vec_id, round(score, 6) AS score FROM ds")
def vec_dot(spark, d):
    return V.dot_scores(_emb(spark, d), _queries(spark, d)).select("query_id", "vec_id", R.round_score())


@register("vec_exact_knn", f"WITH {EXACT_SQL} SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ex")
def vec_exact_knn(spark, d):
    return V.exact_knn(_emb(spark, d), _queries(spark, d), K).select("query_id", "rank", "vec_id", R.round_score())


@register("ivf_centroids_sample", f"WITH {CENT_SQL} SELECT centroid_id, vec_id FROM cen")
def ivf_centroids_sample(spark, d):
    e = _emb(spark, d)
    return V.sample_centroids(e, V.n_centroids(e.count())).select("centroid_id", "vec_id")


@register(
    "ivf_assign",
    f"""WITH {CENT_SQL} SELECT vec_id, centroid_id FROM (
          SELECT e.vec_id, c.centroid_id, row_number() OVER (PARTITION BY e.vec_id ORDER BY {_sqd('e.embedding', 'c.cv')}, c.centroid_id) AS r
          FROM embeddings e CROSS JOIN cen c) WHERE r = 1""",
)
def ivf_assign(spark, d):
    return V.ivf_assign(_emb(spark, d), _centroids(spark, d), 1).select("vec_id", "centroid_id")


@register("ivf_search", f"WITH {_ivf_sql([1])} SELECT query_id, rank, vec_id, round(score, 6) AS score FROM ap")
def ivf_search(spark, d):
    return _ivf(spark, d, [1]).select("query_id", "rank", "vec_id", R.round_score())


@register("ivf_probe_sweep", f"WITH {_ivf_sql([1, 5, 25])} SELECT n_probe, query_id, rank, vec_id, round(score, 6) AS score FROM ap")
def ivf_probe_sweep(spark, d):
    return _ivf(spark, d, [1, 5, 25]).select("n_probe", "query_id", "rank", "vec_id", R.round_score())


@register(
    "vec_recall_at_k",
    f"""WITH {_ivf_sql([1, 5, 25])}
        SELECT ap.n_probe, ap.query_id, round(count(ex.vec_id) / count(*), 6) AS recall
        FROM ap LEFT JOIN ex ON ex.query_id = ap.query_id AND ex.vec_id = ap.vec_id GROUP BY ap.n_probe, ap.query_id""",
)
def vec_recall_at_k(spark, d):
    exact = V.exact_knn(_emb(spark, d), _queries(spark, d), K)
    approx = _ivf(spark, d, [1, 5, 25])
    return V.recall(exact, approx, ["n_probe", "query_id"]).select("n_probe", "query_id", F.round("recall", 6).alias("recall"))


@register("ivf_centroids_kmeans")
def ivf_centroids_kmeans(spark, d):
    """floor(sqrt(n)) KMeans centroids; list sizes when every vector joins its nearest 5 lists."""
    e = _emb(spark, d)
    cen, _ = V.kmeans_centroids(e, V.n_centroids(e.count()))
    lists = V.ivf_assign(e, cen, 5)
    return lists.groupBy("centroid_id").agg(F.count(F.lit(1)).alias("n_vectors"))


@register("ivf_search_kmeans")
def ivf_search_kmeans(spark, d):
    """IVF search probing 5 KMeans lists, with the centroids used for assignment also used to probe."""
    e = _emb(spark, d)
    q = _queries(spark, d)
    cen, _ = V.kmeans_centroids(e, V.n_centroids(e.count()))
    approx = V.ivf_search(e, q, cen, V.ivf_assign(e, cen, 5), [5], K)
    exact = V.exact_knn(e, q, K)
    return V.recall(exact, approx, ["query_id"])


def _signs_sql(dim: int) -> str:
    """Directions and shifts of the index's projections as rows (table_no, j, dir, u)."""
    rows = [f"({t}, {j}, '{AX.signs(t, j, dim)}', {AX.shift(t, j)!r})" for t in range(AX.TABLES) for j in range(MOST_PROJECTIONS)]
    return f"(VALUES {', '.join(rows)}) AS v(table_no, j, dir, u)"


DIM, MOST_PROJECTIONS = 64, 8
ANN_SQL = f"""WITH par AS (SELECT greatest(1, ceil(ln(greatest(count(*), 2)) / ln(9))) AS m,
  round({AX.WIDTH} * sqrt(avg({_dot('embedding', 'embedding')})), 6) AS width FROM embeddings),
pr AS (SELECT e.vec_id, v.table_no, v.j, floor(list_reduce(list_transform(range(1, len(e.embedding) + 1),
         lambda i: CASE WHEN v.dir[i] = '+' THEN e.embedding[i]::DOUBLE ELSE -(e.embedding[i]::DOUBLE) END), lambda x, y: x + y) / par.width + v.u)::BIGINT AS cell
       FROM embeddings e, par, {_signs_sql(DIM)} WHERE v.j < par.m)
SELECT table_no::INT AS table_no, string_agg(cell::VARCHAR, ',' ORDER BY j) AS bucket, vec_id FROM pr GROUP BY table_no, vec_id"""


def _ann_index(spark, d):
    path = scratch_path(spark, "ann-index")
    AX.build(_emb(spark, d), path)
    return path


@register("vec_ann_build", ANN_SQL)
def vec_ann_build(spark, d):
    """The stored index of the vectors: each vector's bucket in every hash table, read back."""
    return AX.read(spark, _ann_index(spark, d), "buckets").select("table_no", "bucket", "vec_id")


@register("vec_ann_query")
def vec_ann_query(spark, d):
    """Approximate 10 nearest by Euclidean distance from the stored index alone, at the target that reached
    0.95 of the exact neighbours of a sample of the queries."""
    path, q = _ann_index(spark, d), _queries(spark, d)
    return AX.search(spark, path, q, K, AX.calibrate(spark, path, q, K))


@register("vec_ann_recall")
def vec_ann_recall(spark, d):
    """Recall of the stored index against the exact 10 nearest, per query."""
    path, q = _ann_index(spark, d), _queries(spark, d)
    return AX.recall(spark, path, q, K, AX.calibrate(spark, path, q, K))


@register("vec_lsh_query")
def vec_lsh_query(spark, d):
    """Approximate 10 nearest by Euclidean distance via an LSH similarity join."""
    return V.lsh_knn(_emb(spark, d), _queries(spark, d), K, bucket_length=0.5, tables=10)


def text_encoder(spark, texts, dim=64):
    """Latent semantic analysis of the column ``text``, as a batch encoder."""
    return LSA.Encoder(spark, LSA.fit(texts, "text", dim))


@register("vec_embed_batch", "SELECT item_id, 64::BIGINT AS dim, CASE WHEN trim(text) = '' THEN 0.0 ELSE 1.0 END AS norm FROM benchmark")
def vec_embed_batch(spark, d):
    """Benchmark texts as vectors of length 1 from an encoder fitted on them, by the batch hook."""
    b = read_table(spark, d, "benchmark")
    out = V.embed(b, "item_id", "text", text_encoder(spark, b))
    return out.select("item_id", F.size("embedding").cast("bigint").alias("dim"), F.round(VF.norm("embedding"), 6).alias("norm"))


@register("lsa_singular_values")
def lsa_singular_values(spark, d):
    """The 64 largest singular values of the documents' tf-idf rows."""
    model = LSA.fit(spread(read_table(spark, d, "documents").select("text")), "text")
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.singular)], "rank int, singular_value double")


@register(
    "lsa_vocabulary",
    f"""WITH t AS (SELECT DISTINCT doc_id, unnest(list_transform({Q.ws("coalesce(text, '')")}, lambda x: lower(x))) AS term FROM documents),
        v AS (SELECT term, count(*) AS df FROM t GROUP BY term ORDER BY df DESC, term LIMIT {LSA.FEATURES})
        SELECT term, round(ln((SELECT count(*) FROM documents) / df) + 1, 6) AS idf FROM v""",
)
def lsa_vocabulary(spark, d):
    """The terms of the encoder over the documents and their weights."""
    terms, idf = LSA.vocabulary(spread(read_table(spark, d, "documents").select("text")), "text")
    return spark.createDataFrame([(t, round(float(idf[i]), 6)) for t, i in terms.items()], "term string, idf double")


@register(
    "vec_cosine",
    f"""WITH {QV_SQL} SELECT q.query_id, e.vec_id,
        round({_dot('e.embedding', 'q.qv')} / (sqrt({_dot('e.embedding', 'e.embedding')}) * sqrt({_dot('q.qv', 'q.qv')})), 6) AS cosine
        FROM embeddings e CROSS JOIN qv q""",
)
def vec_cosine(spark, d):
    """Cosine of every vector with every query vector: the bi-encoder scoring step on ready-made vectors."""
    q = _queries(spark, d).select("query_id", F.col("embedding").alias("qv"))
    return _emb(spark, d).crossJoin(q).select("query_id", "vec_id", F.round(VF.cosine("embedding", "qv"), 6).alias("cosine"))
