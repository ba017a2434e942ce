"""Scoring against brute-force Python, tie rules, per-query k and skew-safe ranking."""

import math
import random

import numpy as np

from quarry.operators import index as I
from quarry.operators import rank as R
from quarry.sources.tables import literal_queries

DOCS = [
    (1, "hdmi cable cable"),
    (2, "hdmi cable"),
    (3, "cable"),
    (4, "the the the cable hdmi"),
    (5, "hdmi cable"),  # duplicate of 2: exact tie
    (6, "nothing here"),
]


def _idf(N, n):
    return math.log((N - n + 0.5) / (n + 0.5))


def _bm25(tf, length, avg, k1=1.2, b=0.75):
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / avg))


def test_bm25_matches_brute_force_and_ties_to_larger_id(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    q = literal_queries(spark, {7: ["hdmi", "cable"]})
    got = [(r.doc_id, r.score) for r in R.search(docs, "doc_id", "text", q, k=10).orderBy("rank").collect()]
    N = len(DOCS)
    avg = sum(len(t.split()) for _, t in DOCS) / N
    df = {w: sum(1 for _, t in DOCS if w in t.split()) for w in ["hdmi", "cable"]}
    exp = []
    for i, t in DOCS:
        toks = t.split()
        if any(w in toks for w in df):
            s = sum(_bm25(toks.count(w), len(toks), avg) * _idf(N, df[w]) for w in df if w in toks)
            exp.append((i, s))
    exp.sort(key=lambda x: (-x[1], -x[0]))
    assert [i for i, _ in got] == [i for i, _ in exp]
    assert all(abs(a - b) < 2e-9 for (_, a), (_, b) in zip(got, exp))  # whole billionths per term
    # documents 2 and 5 are identical: equal scores, larger id first
    pos = {i: n for n, (i, _) in enumerate(got)}
    assert pos[5] < pos[2] and dict(got)[5] == dict(got)[2]


def test_idf_is_negative_for_common_terms(spark):
    df = spark.createDataFrame([(10, 7)], "n_docs long, df long")
    from quarry.functions.scoring import idf

    assert df.select(idf("n_docs", "df")).first()[0] == _idf(10, 7) < 0


def test_topk_batch_per_query_k(spark):
    rows = [(q, d, float(d % 7)) for q in range(3) for d in range(50)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, score double")
    ks = spark.createDataFrame([(0, 1), (1, 3), (2, 10)], "query_id long, k long")
    got = R.topk_batch(df.join(ks, "query_id"), "query_id", 10, k_col="k").groupBy("query_id").count()
    assert {r.query_id: r["count"] for r in got.collect()} == {0: 1, 1: 3, 2: 10}


def test_rank_within_hot_group_equals_window(spark):
    random.seed(1)
    # group 0 holds most rows (hot); scores have ties broken by id
    rows = [(0 if random.random() < 0.7 else random.randint(1, 5), i, float(random.randint(0, 20)), random.randint(0, 1)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g long, id long, s double, rel int")
    got = R.rank_within(df, "g", "s", "id", ties="asc", running="rel")
    got = {(r.g, r.id): (r.rank, r.running_rel) for r in got.collect()}
    exp = {}
    for g in set(r[0] for r in rows):
        grp = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))
        run = 0
        for n, r in enumerate(grp, 1):
            run += r[3]
            exp[(g, r[1])] = (n, run)
    assert got == exp


def test_dense_ids_are_consecutive(spark):
    df = spark.createDataFrame([(f"t{i:04d}",) for i in random.sample(range(5000), 800)], "term string")
    got = sorted((r.idx, r.term) for r in I.dense_ids(df, "term").collect())
    assert [i for i, _ in got] == list(range(800))
    assert [t for _, t in got] == sorted(t for _, t in got)


def test_plan_has_partial_top_k_and_no_collect_list(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    plan = R.search(docs, "doc_id", "text", literal_queries(spark, {1: ["hdmi"]}))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert "collect_list" not in plan


def test_long_queries_count_repeated_terms(spark):
    docs = spark.createDataFrame([*DOCS, (9, None), (10, "")], "doc_id bigint, text string")
    words = ["cable", "hdmi", "cable", "absent"] + [f"w{i}" for i in range(5000)]
    got = {r.doc_id: r.score for r in R.score_queries(docs, "doc_id", "text", literal_queries(spark, {1: words}), "tf").collect()}
    exp = {i: float(sum(t.split().count(w) for w in words)) for i, t in DOCS if set(t.split()) & set(words)}
    assert got == exp


def test_term_counts_and_positions_in_the_row(spark):
    docs = spark.createDataFrame([*DOCS, (9, None), (10, ""), (11, "x " * 3000 + "y")], "doc_id bigint, text string")
    got = {(r.doc_id, r.term): (r.tf, r.doc_len) for r in I.build_tf_postings(docs, "doc_id", "text").collect()}
    rows = [(i, (t or "").split()) for i, t in [*DOCS, (11, "x " * 3000 + "y")]]
    assert got == {(i, w): (t.count(w), len(t)) for i, t in rows for w in t}
    pos = {(r.doc_id, r.term): list(r.positions) for r in I.build_positional(docs, "doc_id", "text").collect()}
    assert pos == {(i, w): [n for n, x in enumerate(t) if x == w] for i, t in rows for w in t}


def test_search_makes_no_row_per_query_and_document(spark):
    """Equal to every score ranked; what leaves the tasks is k rows per query and task."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(12)] + ["the"] * 6
    rows = [(rng.choice([i, i, i, 7]), " ".join(rng.choices(words, k=rng.randint(0, 9)))) for i in range(700)] + [(None, "the w1 w2"), (5000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    queries = literal_queries(spark, {q: rng.choices(words, k=rng.randint(1, 5)) for q in range(30)} | {99: ["absent"]})
    for model in ("bm25", "tfidf", "tf"):
        scored = R.score_queries(docs, "doc_id", "text", queries, model)
        want = R.topk_batch(scored, "query_id", 10).select("query_id", "rank", "doc_id", "score")
        assert sorted(map(str, R.search(docs, "doc_id", "text", queries, 10, model).collect())) == sorted(map(str, want.collect()))
    best = R.best_scored(docs, "doc_id", "text", queries, 10)
    tasks = best.rdd.getNumPartitions()
    assert best.count() <= 10 * 31 * tasks < scored.count()
    plan = best._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Aggregate [query_id" not in plan


def test_search_in_blocks_of_queries_and_of_documents(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"a{i % 3} b{i % 5} c") for i in range(90)], "doc_id long, text string")
    queries = literal_queries(spark, {q: [f"a{q % 3}", f"b{q % 4}", "c", "c"] for q in range(9)})
    want = sorted(map(str, R.search(docs, "doc_id", "text", queries, 5).collect()))
    monkeypatch.setattr(R, "CELLS", 12)
    monkeypatch.setattr(R, "DOCS", 7)
    monkeypatch.setattr(R, "EXACT", 1)
    assert len(list(R._query_blocks(queries))) > 2
    assert sorted(map(str, R.search(docs, "doc_id", "text", queries, 5).collect())) == want


def test_products_of_great_numbers_are_whole():
    u = np.array([[3.0 * 2**50, 1.0], [-(2.0**50), 7.0]])
    times = np.array([[3.0, 0.0], [1.0, 5.0]])
    want = [[sum(int(a) * int(b) for a, b in zip(r, c, strict=True)) for c in times.T] for r in u]
    assert R._products(u, times).tolist() == want


def test_all_models_move_the_same_columns(spark, tmp_path):
    """The exchange that the statistics read serves the scores, also where the model needs no length."""
    spark.createDataFrame(DOCS, "doc_id bigint, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for model in ("bm25", "tfidf", "tf"):
        best = R.best_scored(docs, "doc_id", "text", literal_queries(spark, {1: ["hdmi"]}), 3, model)
        plan = best._jdf.queryExecution().optimizedPlan().toString().splitlines()
        below = [plan[i + 1] for i, line in enumerate(plan) if "RepartitionByExpression [doc_id" in line]
        assert len(below) == (1 if model == "tf" else 3) and all("doc_len" in x and "tf" in x for x in below)


def test_parts_have_their_own_best(spark):
    docs = spark.createDataFrame([(i, i % 2, f"a b{i % 4}") for i in range(40)], "doc_id long, shard int, text string")
    queries = literal_queries(spark, {1: ["a", "b1"], 2: ["b2"]})
    keyed = docs.selectExpr("struct(shard, doc_id) AS key", "text")
    got = R.topk_batch(R.best_scored(keyed, "key", "text", queries, 3, part="shard"), ["shard", "query_id"], 3)
    scored = R.score_queries(docs, "doc_id", "text", queries).join(docs.select("doc_id", "shard"), "doc_id")
    want = R.topk_batch(scored, ["shard", "query_id"], 3)
    cols = "shard", "query_id", "rank", "doc_id", "score"
    assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want.select(*cols).collect()))
