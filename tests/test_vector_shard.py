"""Vector and shard invariants on the driver's embeddings / documents tables."""

from pyspark.sql import functions as F

from conftest import SF001
from quarry.operators import shard as SH
from quarry.operators import vector as V
from quarry.sources.tables import read_table


def _q(spark):
    e = read_table(spark, SF001, "embeddings")
    return e, V.mean_vectors(e, "label").withColumnRenamed("label", "query_id")


def test_ivf_probing_all_lists_is_exact(spark):
    e, q = _q(spark)
    cen = V.sample_centroids(e, V.n_centroids(e.count()))
    m = cen.count()
    exact = V.exact_knn(e, q, 10)
    approx = V.ivf_search(e, q, cen, V.ivf_assign(e, cen, m), [m], 10)
    r = V.recall(exact, approx, ["query_id"]).collect()
    assert r and all(x.recall == 1.0 for x in r)


def test_lsh_distances_are_exact(spark):
    e, q = _q(spark)
    got = V.lsh_knn(e, q, 5, bucket_length=1.0, tables=4)
    from quarry.functions import vectors as VF

    chk = got.join(e, "vec_id").join(q.withColumnRenamed("embedding", "qv"), "query_id").select(
        "dist", VF.l2_dist("embedding", "qv").alias("d")
    )
    assert all(abs(r.dist - r.d) < 1e-4 for r in chk.collect())


def test_lsh_gives_k_rows_for_every_query(spark):
    e, q = _q(spark)
    for length in (0.01, 0.5):  # with tiny buckets hardly anything collides: the exact search steps in
        got = V.lsh_knn(e, q, 10, bucket_length=length, tables=2)
        assert {r.query_id: r["count"] for r in got.groupBy("query_id").count().collect()} == {r.query_id: 10 for r in q.collect()}
    exact = {(r.query_id, r.rank, r.vec_id) for r in V.exact_l2(e, q, 10).collect()}
    assert {(r.query_id, r.rank, r.vec_id) for r in V.lsh_knn(e, q, 10, bucket_length=1e-6, tables=1).collect()} == exact


def test_assignment_filter(spark):
    e, _ = _q(spark)
    cen = V.sample_centroids(e, 5)
    every = V.ivf_assign(e, cen, 3)
    near = V.ivf_assign(e, cen, 3, keep=F.col("dist") < 1.0)
    assert 0 <= near.count() < every.count() == 3 * e.count()


def test_kmeans_lists_hold_every_vector(spark):
    e, _ = _q(spark)
    cen, _ = V.kmeans_centroids(e, 7)
    lists = V.ivf_assign(e, cen, 2)
    assert lists.count() == 2 * e.count() and lists.select("vec_id").distinct().count() == e.count()


def test_sharded_topk_equals_global(spark):
    rows = [(q, d, float((d * 7 + q) % 13)) for q in range(4) for d in range(300)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, score double")
    from quarry.operators.rank import topk_batch

    glob = {(r.query_id, r.rank, r.doc_id) for r in topk_batch(df, "query_id", 10).collect()}
    shd = {(r.query_id, r.rank, r.doc_id) for r in SH.sharded_topk(SH.assign_shard(df, "doc_id", 4), 10).collect()}
    assert glob == shd


def test_split_moves_only_to_s_plus_n(spark):
    docs = read_table(spark, SF001, "documents")
    for r in SH.split_shards(docs, "doc_id", 2).collect():
        assert r.new_shard in (r.old_shard, r.old_shard + 2)


def test_md5_mod_matches_python(spark):
    import hashlib

    from quarry.functions.hashing import md5_mod

    words = ["the", "of", "Information", "ü", "x" * 50]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = [r[0] for r in df.select(md5_mod("w", 7919)).collect()]
    assert got == [int(hashlib.md5(w.encode()).hexdigest(), 16) % 7919 for w in words]


def test_blas_nearest_centroids_equal_join_path_with_ties(spark):
    import random

    random.seed(5)
    vecs = [(i, [random.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    cents = [(c, [random.uniform(-1, 1) for _ in range(8)]) for c in range(12)]
    cents.append((12, list(cents[3][1])))  # exact duplicate of centroid 3: ties go to the lower id
    v = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    c = spark.createDataFrame(cents, "centroid_id long, embedding array<double>")
    for n in (1, 3):
        a = sorted((r.vec_id, r.centroid_id) for r in V.nearest_centroids(v, c, n).collect())
        exp = []
        for i, x in vecs:
            d = sorted((sum((a - b) ** 2 for a, b in zip(x, y)), c) for c, y in cents)
            exp += [(i, c) for _, c in d[:n]]
        assert a == sorted(exp)


def test_blocks_don_t_change_the_nearest(spark, monkeypatch):
    e, q = _q(spark)
    cen = V.sample_centroids(e, 12)
    one = {tuple(r) for r in V.nearest_centroids(e, cen, 3).collect()}, {tuple(r) for r in V.exact_knn(e, q, 5).collect()}
    monkeypatch.setattr(V, "BLOCK", 5)
    many = {tuple(r) for r in V.nearest_centroids(e, cen, 3).collect()}, {tuple(r) for r in V.exact_knn(e, q, 5).collect()}
    assert [(v, c, r) for v, c, _, r in sorted(one[0])] == [(v, c, r) for v, c, _, r in sorted(many[0])]
    assert [(a, b, c) for a, b, _, c in sorted(one[1])] == [(a, b, c) for a, b, _, c in sorted(many[1])]


def test_blas_exact_knn_equals_join_path_with_ties(spark):
    import random

    from quarry.operators.rank import topk_batch

    random.seed(7)
    vecs = [(i, [random.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    vecs += [(1000 + i, list(vecs[i][1])) for i in range(20)]  # duplicates: equal scores, larger id first
    qs = [(q, [random.uniform(-1, 1) for _ in range(6)]) for q in range(5)]
    v = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").repartition(4)
    q = spark.createDataFrame(qs, "query_id long, embedding array<double>")
    a = sorted((r.query_id, r.rank, r.vec_id) for r in V.exact_knn(v, q, 10).collect())
    b = sorted((r.query_id, r.rank, r.vec_id) for r in topk_batch(V.dot_scores(v, q), "query_id", 10, id_col="vec_id").collect())
    assert a == b


def test_lsh_equals_the_similarity_join_and_moves_no_bucket(spark):
    import random

    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    rows += rows[:40] + [(900 + i, rows[i][1]) for i in range(20)]  # the same rows again, and equal vectors
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    queries = spark.createDataFrame([(i, rows[7 * i][1]) for i in range(6)], "query_id long, embedding array<double>")
    got = V.lsh_knn(vecs, queries, 5, bucket_length=0.5, tables=4)
    model, feats = V.lsh_model(vecs, 0.5, 4)
    pairs = model.approxSimilarityJoin(feats, V._features(queries), float("inf"), distCol="dist")
    near: dict = {}
    for r in pairs.collect():
        near.setdefault(r.datasetB.query_id, []).append((round(r.dist, 9), r.datasetA.vec_id))
    want = {(q, i + 1, v, d) for q, x in near.items() for i, (d, v) in enumerate(sorted(x)[:5]) if len(x) >= 5}
    assert want and want <= {(r.query_id, r.rank, r.vec_id, round(r.dist, 9)) for r in got.collect()}
    assert got.count() == 30
