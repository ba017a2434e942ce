"""Vector similarity search: exact top-k, IVF (coarse quantisation) and LSH.

Query vectors and centroids are stated sets that meet all rows in blocks: a block of at most
``BLOCK`` vectors is broadcast, every task scores its rows against it with BLAS and keeps the best
of the block, and a partial top-k merges the blocks. One plan at every size; the driver and a task
hold one block. IVF restricts the candidates to the probed centroid lists.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import vectors as V
from quarry.operators import rank as R
from quarry.operators.index import dense_ids

BLOCK = 4096  # query vectors or centroids that a task holds at a time
ROWS = 2048  # rows scored against a block at a time


def blocks(vectors: DataFrame, id_col: str, vec_col: str = "embedding") -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) blocks of a table of vectors, streamed partition by partition."""
    ids, rows = [], []
    for r in vectors.select(F.col(id_col).cast("long").alias("i"), F.col(vec_col).cast("array<double>").alias("v")).toLocalIterator():
        ids.append(r["i"])
        rows.append(np.array(r["v"]))
        if len(ids) == BLOCK:
            yield np.array(ids, np.int64), np.stack(rows)
            ids, rows = [], []
    if ids:
        yield np.array(ids, np.int64), np.stack(rows)


def mean_vectors(vecs: DataFrame, group: str, vec: str = "embedding", out: str = "embedding") -> DataFrame:
    """Per-group element-wise mean vector (partial aggregation per (group, dimension))."""
    per_dim = vecs.select(group, F.posexplode(vec).alias("i", "v")).groupBy(group, "i").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return per_dim.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda s: s["v"]).alias(out)
    )


def dot_scores(docs: DataFrame, queries: DataFrame, id_col: str = "vec_id") -> DataFrame:
    """(query_id, id, score) for every document and query: the whole matrix is the result."""
    q = queries.select("query_id", F.col("embedding").alias("qv"))
    return docs.crossJoin(q).select("query_id", id_col, V.dot("embedding", "qv").alias("score"))


def _merged(parts: list[DataFrame], empty: DataFrame) -> DataFrame:
    out = empty
    for part in parts:
        out = part if out is empty else out.unionByName(part)
    return out


def _best_per_query(docs: DataFrame, queries: DataFrame, k: int, id_col: str, score) -> DataFrame:
    """(query_id, id, score) holding each query's best k, ties to the larger id, and at most k rows
    per query and task. ``score``: rows x block matrix of two matrices, larger is better."""
    schema = T.StructType(
        [T.StructField("query_id", T.LongType()), T.StructField(id_col, T.LongType()), T.StructField("score", T.DoubleType())]
    )
    rows = docs.select(F.col(id_col).cast("long").alias(id_col), "embedding")
    parts = []
    for block in blocks(queries, "query_id"):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            qids, q = shared.value
            best_s, best_i = np.full((len(qids), 0), 0.0), np.zeros((len(qids), 0), np.int64)
            for pdf in batches:
                for at in range(0, len(pdf), ROWS):
                    ids = pdf[id_col].to_numpy(np.int64)[at : at + ROWS]
                    s = score(np.stack(pdf["embedding"].iloc[at : at + ROWS]).astype(np.float64), q).T
                    s = np.concatenate([best_s, s], axis=1)
                    i = np.concatenate([best_i, np.broadcast_to(ids, (len(qids), len(ids)))], axis=1)
                    order = np.lexsort((-i, -s), axis=1)[:, :k]
                    best_s, best_i = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)
            n = best_s.shape[1]
            yield pd.DataFrame({"query_id": np.repeat(qids, n), id_col: best_i.ravel(), "score": best_s.ravel()})

        parts.append(rows.mapInPandas(run, schema))
    return R.topk_batch(_merged(parts, docs.sparkSession.createDataFrame([], schema)), "query_id", k, id_col=id_col)


def exact_knn(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id") -> DataFrame:
    """Exact top-k by dot product for a batch of queries, ties to the larger id."""
    return _best_per_query(docs, queries, k, id_col, lambda x, q: x @ q.T)


def exact_l2(docs: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id") -> DataFrame:
    """(query_id, rank, id, dist): the exact k nearest by Euclidean distance."""

    def near(x, q):
        return -np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] - 2 * x @ q.T + (q * q).sum(1)))

    out = _best_per_query(docs, queries, k, id_col, near)
    return out.select("query_id", "rank", id_col, (-F.col("score")).alias("dist"))


def n_centroids(n: int) -> int:
    return int(math.floor(math.sqrt(n)))


def sample_centroids(vecs: DataFrame, m: int, id_col: str = "vec_id") -> DataFrame:
    """The m vectors with the smallest md5(id), numbered 0..m-1 in that order (a deterministic sample).

    A global ``orderBy(md5).limit(m)`` would send m rows to one task. Instead a
    distributed filter keeps ids whose top 32 md5 bits fall under a threshold sized for ~2m rows;
    because the top bits order the full hash, the m smallest are all kept whenever at least m rows
    pass (checked; the threshold doubles otherwise), and only those ~2m rows are sorted."""
    n = vecs.count()
    h = F.md5(F.col(id_col).cast("string"))
    top32 = F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    frac = min(1.0, 2.0 * m / max(n, 1))
    while True:
        t = int(frac * 4294967296)
        kept = vecs.select(id_col, "embedding", h.alias("h")).where(top32 < F.lit(t))
        if frac >= 1.0 or kept.count() >= m:
            break
        frac = min(1.0, frac * 2)
    numbered = dense_ids(kept, "h", "centroid_id")
    return numbered.where(F.col("centroid_id") < m).select("centroid_id", id_col, "embedding")


def kmeans_centroids(vecs: DataFrame, m: int, seed: int = 0, max_iter: int = 20) -> DataFrame:
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = vecs.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    model = KMeans(k=m, seed=seed, maxIter=max_iter).fit(feats)
    spark = vecs.sparkSession
    centers = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(centers, "centroid_id int, embedding array<double>"), model


def nearest_centroids(vecs: DataFrame, centroids: DataFrame, n: int, id_col: str = "vec_id") -> DataFrame:
    """(id, centroid_id, dist, rank): each vector's n nearest centroids (Euclidean, ties: lower id).

    ||x||^2 - 2x.c + ||c||^2 picks the candidates of a block, a few more than n; they are scored again
    exactly as sum((x - c)^2) and ordered by (distance, id). A row whose next candidate is within
    rounding of the last one taken is scored against the whole block. So the result is exact."""
    schema = T.StructType(
        [T.StructField(id_col, vecs.schema[id_col].dataType), T.StructField("centroid_id", T.LongType()), T.StructField("d2", T.DoubleType())]
    )
    rows, parts = vecs.select(id_col, "embedding"), []
    for block in blocks(centroids, "centroid_id"):
        shared = vecs.sparkSession.sparkContext.broadcast(block)

        def run(batches, shared=shared):
            ids, c = shared.value
            order = np.argsort(ids)
            ids, c = ids[order], c[order]  # equal distances then stand in id order
            norms = (c * c).sum(1)
            take = min(n, len(ids))
            pool = min(len(ids), take + 8)

            def exact(x, cand):
                d = ((x[:, None, :] - c[cand]) ** 2).sum(axis=2)
                best = np.argsort(d, axis=1, kind="stable")[:, :take]
                return np.take_along_axis(cand, best, 1), np.take_along_axis(d, best, 1)

            for pdf in batches:
                for at in range(0, len(pdf), ROWS):
                    part = pdf.iloc[at : at + ROWS]
                    x = np.stack(part["embedding"]).astype(np.float64)
                    sq = (x * x).sum(1)
                    rough = sq[:, None] - 2 * x @ c.T + norms
                    cand = np.sort(np.argpartition(rough, pool - 1, axis=1)[:, :pool], axis=1)
                    near, d = exact(x, cand)
                    if pool < len(ids):
                        edge = np.take_along_axis(rough, cand, 1).max(axis=1)
                        for r in np.flatnonzero(d[:, -1] >= edge - 1e-9 * (sq + norms.max())):
                            near[r : r + 1], d[r : r + 1] = exact(x[r : r + 1], np.arange(len(ids))[None, :])
                    yield pd.DataFrame({id_col: np.repeat(part[id_col].to_numpy(), take), "centroid_id": ids[near].ravel(), "d2": d.ravel()})

        parts.append(rows.mapInPandas(run, schema))
    merged = _merged(parts, vecs.sparkSession.createDataFrame([], schema)).withColumn("_near", -F.col("d2"))
    top = R.topk_batch(merged, id_col, n, score="_near", id_col="centroid_id", ties="asc")
    return top.select(id_col, "centroid_id", F.sqrt("d2").alias("dist"), "rank")


def ivf_assign(vecs: DataFrame, centroids: DataFrame, n: int, id_col: str = "vec_id", keep=None) -> DataFrame:
    """Inverted lists: (centroid_id, id, rank) with every vector in its n nearest lists. ``keep`` (a
    condition over centroid_id, dist and rank) filters the assignments."""
    lists = nearest_centroids(vecs, centroids, n, id_col)
    return (lists if keep is None else lists.where(keep)).select("centroid_id", id_col, "rank")


def ivf_search(
    vecs: DataFrame, queries: DataFrame, centroids: DataFrame, lists: DataFrame, n_probes: list[int], k: int, id_col: str = "vec_id"
) -> DataFrame:
    """(n_probe, query_id, rank, id, score): for each n of ``n_probes``, probe the query's n nearest of
    the lists that hold every vector n times, rerank the candidates by exact dot, best k.

    ``lists`` come from one assignment to max(n_probes) lists: a pair is a candidate from the least
    n that covers both the list's rank for the vector and its rank for the query, so all n share one
    join and one score per (query, vector). A crowded list is a hot join key that AQE splits."""
    most = max(n_probes)
    probes = nearest_centroids(queries.withColumnRenamed("query_id", "_q"), centroids, most, "_q")
    probes = probes.select(F.col("_q").alias("query_id"), "centroid_id", F.col("rank").alias("_r"))
    cand = lists.join(probes, "centroid_id").groupBy("query_id", id_col).agg(F.min(F.greatest("rank", "_r")).alias("least"))
    q = queries.select("query_id", F.col("embedding").alias("qv"))
    scored = cand.join(vecs.select(id_col, "embedding"), id_col).join(q, "query_id")
    scored = scored.select("query_id", id_col, "least", V.dot("embedding", "qv").alias("score"))
    params = F.array(*[F.lit(n) for n in n_probes])
    each = scored.withColumn("n_probe", F.explode(F.filter(params, lambda n: n >= F.col("least")))).drop("least")
    return R.topk_batch(each, ["n_probe", "query_id"], k, id_col=id_col)


def recall(exact: DataFrame, approx: DataFrame, keys: list[str], id_col: str = "vec_id") -> DataFrame:
    """|exact ∩ approx| / |approx| per query (ids compared, not scores)."""
    a = approx.select(*keys, id_col)
    hit = a.join(exact.select("query_id", id_col), ["query_id", id_col], "left_semi").groupBy(*keys).agg(F.count(F.lit(1)).alias("hits"))
    tot = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return tot.join(hit, keys, "left").select(*keys, (F.coalesce("hits", F.lit(0)) / F.col("n")).alias("recall"))


# ---- LSH (Euclidean) -------------------------------------------------------------------------


def _features(vecs: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return vecs.withColumn("features", array_to_vector(F.col("embedding").cast("array<double>")))


def lsh_model(vecs: DataFrame, bucket_length: float = 1.0, tables: int = 10, seed: int = 0):
    from pyspark.ml.feature import BucketedRandomProjectionLSH

    feats = _features(vecs)
    lsh = BucketedRandomProjectionLSH(inputCol="features", outputCol="hashes", bucketLength=bucket_length, numHashTables=tables, seed=seed)
    return lsh.fit(feats), feats


def lsh_knn(vecs: DataFrame, queries: DataFrame, k: int, bucket_length: float = 1.0, tables: int = 10, id_col: str = "vec_id"):
    """Approximate k nearest by Euclidean distance among the vectors that share a bucket of any hash table.
    The queries' buckets meet the vectors in blocks: tasks keep each query's best k, so that neither buckets nor
    pairs move, only the vectors, once, to drop rows that occur twice. Queries that share buckets with fewer
    than k vectors are searched exactly, so every query has k rows (or as many as there are vectors)."""
    from pyspark.ml.functions import vector_to_array

    from quarry.operators.util import materialize

    model, _ = lsh_model(vecs, bucket_length, tables)

    def hashed(df, id_col, number):
        """The buckets follow the components in one array."""
        buckets = [vector_to_array(F.col("hashes")[i])[0] for i in range(tables)]
        both = F.concat(F.col("embedding").cast("array<double>"), F.array(*buckets))
        return model.transform(_features(df)).select(number.alias(id_col), both.alias("embedding"))

    def near(x, q):
        out = np.full((len(x), len(q)), -np.inf)
        shared = (x[:, None, -tables:] == q[None, :, -tables:]).any(axis=2)
        row, of = np.nonzero(shared)
        # added in order, as MLlib adds
        out[row, of] = -np.sqrt(np.cumsum((x[row, :-tables] - q[of, :-tables]) ** 2, axis=1)[:, -1])
        return out

    # ties go to the smaller id, an unknown one first: numbers in the opposite order
    none = F.lit(-(1 << 63)).cast("long")
    docs = hashed(vecs.distinct(), id_col, F.bitwise_not(F.coalesce(F.col(id_col).cast("long"), none)))
    top = _best_per_query(docs, hashed(queries, "query_id", F.col("query_id")), k, id_col, near)
    top = top.where(F.col("score") > float("-inf")).withColumn("dist", -F.col("score"))
    top = top.withColumn(id_col, F.nullif(F.bitwise_not(F.col(id_col)), none))
    top = materialize(top.select("query_id", "rank", id_col, "dist"))
    full = top.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    rest = exact_l2(vecs, queries.join(full, "query_id", "left_anti"), k, id_col)
    return top.join(full, "query_id", "left_semi").unionByName(rest)


# ---- batch encoder (mapInPandas) -------------------------------------------------------------

ENCODER_BATCH = 512


def embed(df: DataFrame, id_col: str, text_col: str, encoder, batch: int = ENCODER_BATCH) -> DataFrame:
    """(id, embedding) by calling ``encoder`` (list of texts -> matrix) on batches of ``batch`` texts
    inside each task: the place for a model of one's own. ``ltr.encode`` needs none."""
    id_type = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def run(it):
        for pdf in it:
            for s in range(0, len(pdf), batch):
                part = pdf.iloc[s : s + batch]
                vecs = np.asarray(encoder(part[text_col].tolist()), np.float32)
                yield pd.DataFrame({id_col: part[id_col].values, "embedding": list(vecs)})

    return df.select(id_col, text_col).mapInPandas(run, schema)
