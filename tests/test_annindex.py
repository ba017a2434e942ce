"""The stored vector index: buckets against numpy, pruned reads, exactness and recall."""

import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from quarry.operators import annindex as AX
from quarry.operators import vector as V
from quarry.session import scratch_path
from quarry.sources.tables import read_table


def _clustered(spark, n=600, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim)) * 2
    x = (centres[rng.integers(0, 20, n)] + 0.3 * rng.normal(size=(n, dim))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(n, x[0].tolist())] * 3 + [(n + 1, None)]
    vecs = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    queries = [(q, (centres[q] + 0.3 * rng.normal(size=dim)).tolist()) for q in range(12)]
    return vecs, spark.createDataFrame(queries, "query_id long, embedding array<double>"), x


@pytest.fixture(scope="module")
def index(spark):
    vecs, queries, x = _clustered(spark)
    path = scratch_path(spark, "ann").removeprefix("file:")
    return path, AX.build(vecs, path), vecs, queries, x


def test_buckets_equal_numpy(spark, index):
    path, p, _, _, x = index
    held = [*x, x[0], x[0], x[0]]
    width = 1.5 * math.sqrt(np.mean([float((v.astype(np.float64) ** 2).sum()) for v in held]))
    assert p == AX.Params(10, math.ceil(math.log(604, 9)), 16, round(width, 6))
    want = set()
    for i, v in enumerate(held):
        for t in range(p.tables):
            cell = []
            for j in range(p.projections):
                y = sum(float(e) if s == "+" else -float(e) for e, s in zip(v, AX.signs(t, j, 16), strict=True))
                cell.append(math.floor(y / p.width + AX.shift(t, j)))
            want.add((t, ",".join(map(str, cell)), min(i, 600)))
    got = AX.read(spark, path, "buckets").collect()
    assert {(r.table_no, r.bucket, r.vec_id) for r in got} == want and len(got) == 10 * 603
    n = {(r.table_no, r.bucket): r.n for r in AX.read(spark, path, "sizes").collect()}
    assert sum(n.values()) == 6030 and set(n) == {(t, b) for t, b, _ in want}


def test_probes_are_the_nearest_buckets(spark, index):
    path, p, _, queries, _ = index
    sizes = AX.read(spark, path, "sizes").collect()
    got = AX.probes(spark, path, queries, 100).collect()
    for q in queries.collect():
        y = AX.cells(np.array([q.embedding]), p)[0]
        far = []
        for s in sizes:
            c = np.array(s.bucket.split(","), float)
            off = np.maximum(np.maximum(c - y[s.table_no], y[s.table_no] - c - 1), 0)
            far.append(((off * off).sum(), s.table_no, s.bucket, s.n))
        want, held = [], 0
        for _, t, b, n in sorted(far):
            if held >= 100:
                break
            want.append((t, b))
            held += n
        assert {(r.table_no, r.bucket) for r in got if r.query_id == q.query_id} == set(want)


def test_all_buckets_give_the_exact_answer(spark, index):
    path, _, vecs, queries, _ = index
    exact = V.exact_l2(vecs.where("embedding IS NOT NULL").distinct(), queries, 10).collect()
    got = AX.search(spark, path, queries, 10, 10**9)
    rounded = lambda rows: sorted((r.query_id, r.vec_id, round(r.dist, 6)) for r in rows)
    near = rounded(got.dropDuplicates(["query_id", "vec_id"]).collect())
    assert {r[2] for r in near} <= {round(r.dist, 6) for r in exact} and len(got.collect()) == 120


def test_recall_and_calibration(spark, index):
    path, _, _, queries, _ = index
    target = AX.calibrate(spark, path, queries, 10, 0.95)
    found = AX.recall(spark, path, queries, 10, target)
    assert found.agg(F.avg("recall")).first()[0] >= 0.9
    assert target < 10 * 603  # far from everything
    seen = AX.probes(spark, path, queries, target).groupBy("query_id").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    assert seen < 10 * 603 / 2


def test_reads_only_the_index_and_only_some_folders(spark, index):
    path, _, _, queries, _ = index
    out = AX.search(spark, path, queries.limit(1), 5, 20)
    assert all(path in f or "/probes-" in f for f in out.inputFiles())
    plan = out._jdf.queryExecution().executedPlan().toString()
    visited = [r.slot for r in AX.probes(spark, path, queries.limit(1), 20).select("slot").distinct().collect()]
    folders = [f for f in os.listdir(f"{path}/buckets") if f.startswith("slot=")]
    pruned = re.search(r"PartitionFilters: \[([^\]]*slot[^\]]*)\]", plan).group(1)
    assert 0 < len(visited) < len(folders) and all(str(s) in pruned for s in visited)


def test_recall_on_the_given_vectors(spark):
    vecs = read_table(spark, SF001, "embeddings")
    path = scratch_path(spark, "ann")
    AX.build(vecs, path)
    q = V.mean_vectors(vecs, "label").withColumnRenamed("label", "query_id").withColumn("query_id", F.col("query_id").cast("long"))
    target = AX.calibrate(spark, path, q, 10)
    assert AX.recall(spark, path, q, 10, target).agg(F.min("recall"), F.avg("recall")).first()[1] >= 0.9


def test_empty_table(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    path = scratch_path(spark, "ann")
    AX.build(empty, path)
    q = spark.createDataFrame([(1, [1.0])], "query_id long, embedding array<double>")
    assert AX.search(spark, path, q, 5, AX.calibrate(spark, path, q, 5)).count() == 0
