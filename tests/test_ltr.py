"""Learning-to-rank operators on small literal pairs."""

import random

from quarry.operators import ltr as LT


def test_listwise_trees_learn_a_separable_ranking(spark):
    random.seed(3)
    labels = ["E", "S", "C", "I"]
    gain = {"E": 4, "S": 2, "C": 1, "I": 0}
    rows = []
    for q in range(6):
        for d in range(12):
            lab = random.choice(labels)
            rows.append((q, q * 100 + d, lab, float(gain[lab]) + random.random() * 0.1, random.random()))
    df = spark.createDataFrame(rows, "query_id long, doc_id long, label string, f double, noise double")
    trees, rate = LT.fit_listwise_trees(df, ["f", "noise"], rounds=5, rate=0.5, depth=3)
    scored = LT.listwise_scores(trees, rate, df, ["f", "noise"])
    nd = LT.ndcg_of_scores(scored, df, 10).first()
    assert nd.mean_ndcg > 0.99 and nd.n_queries == 6


def test_minmax_constant_feature_is_null(spark):
    df = spark.createDataFrame([(1, 1, "train", 2.0, 1.0), (1, 2, "train", 4.0, 1.0), (2, 3, "test", 3.0, 1.0)], "query_id long, doc_id long, split string, a double, b double")
    out = {r.doc_id: (r.a, r.b) for r in LT.minmax(df, ["a", "b"]).collect()}
    assert out == {1: (0.0, None), 2: (1.0, None), 3: (0.5, None)}


def test_number_of_trees_is_the_number_of_rounds(spark):
    rows = [(q, q * 10 + d, ["E", "S", "C", "I"][d % 4], "train", float(d % 4), float(q)) for q in range(6) for d in range(8)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, label string, split string, f double, g double")
    trees, _ = LT.fit_listwise_trees(df, ["f", "g"], rounds=4)
    assert len(trees) == 4
    top = LT.top_features(trees, ["f", "g"], 2)
    assert top[0][0] == "f" and top[0][1] > top[1][1] and abs(sum(v for _, v in top) - 1) < 1e-9


def test_features_equal_brute_force(spark):
    import math

    rows = [
        (1, 10, "a b a", "a x", "a a b c", "E", "train"),
        (1, 11, "a b a", None, "b", "I", "train"),
        (2, 12, "c zz", "c c c", "", "S", "train"),
        (2, 13, "", "c", "d", "C", "test"),
        (3, 14, "b c", "b c b", "a", "C", "test"),
    ]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, query string, title string, description string, label string, split string")
    got = {r.doc_id: r for r in LT.features(df).collect()}
    train = [r for r in rows if r[6] == "train"]
    assert set(got) == {r[1] for r in rows}
    for q, i, query, title, desc, *_ in rows:
        for short, text, at in (("title", title, 3), ("desc", desc, 4)):
            toks = (text or "").split()
            avg = sum(len((r[at] or "").split()) for r in train) / len(train)
            tfs = [float(toks.count(w)) for w in query.split()]
            assert got[i][f"{short}_len"] == len(toks)
            if not tfs:
                assert got[i][f"{short}_tf_sum"] is None
                continue
            dfs = [sum(w in (r[at] or "").split() for r in train) for w in query.split()]
            idf = [math.log((len(train) - d + 0.5) / (d + 0.5)) for d in dfs]
            bm = [t * 2.2 / (t + 1.2 * (0.25 + 0.75 * len(toks) / avg)) * x for t, x in zip(tfs, idf, strict=True)]
            for name, v in (("tf", tfs), ("tfidf", [t * x for t, x in zip(tfs, idf, strict=True)]), ("bm25", bm)):
                m = sum(v) / len(v)
                exp = (sum(v), m, sum((x - m) ** 2 for x in v) / len(v))
                for kind, e in zip(("sum", "avg", "var"), exp, strict=True):
                    assert abs(got[i][f"{short}_{name}_{kind}"] - e) < 1e-9


def test_penalty_rule(spark):
    rows = [(1, [("E", 0.5), ("I", 0.2)]), (2, [("E", 0.5), ("S", 0.3)]), (3, []), (4, None)]
    df = spark.createDataFrame(rows, "i int, outputs array<struct<token: string, score: double>>")
    assert [r[0] for r in df.orderBy("i").select(LT.penalty("outputs")).collect()] == [0.2, 0.3, 1.0, 1.0]


def test_biencoder_scores_and_encoder(spark):
    rows = [(1, 1, "red bolt", "Red BOLT"), (1, 2, "red bolt", "blue nut"), (2, 3, "", "x"), (2, 4, None, "x"), (3, 5, "x", None)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, query string, title string")
    got = {r.doc_id: r.score for r in LT.biencoder_scores(df).collect()}
    assert len(got) == 5 and abs(got[1] - 1) < 1e-9 and got[2] < 0.99 and got[3] == got[4] == got[5] == 0


def test_batch_scorer_outputs_and_loads(spark, tmp_path):
    """The hook's outputs per pair, its batches, and one load per worker."""
    import os

    path = str(tmp_path / "loads")

    class Scorer:
        key = "a double"

        def load(self):
            with open(path, "a") as f:
                f.write(f"{os.getpid()}\n")

            def outputs(queries, titles):
                assert 0 < len(queries) == len(titles) <= 8
                return [[("E", len(q) / 10), ("I", len(t) / 100)] if q else [("S", 0.5)] for q, t in zip(queries, titles)]

            return outputs

    rows = [(i, i, "q" * (i % 4) if i % 7 else None, "t" * (i % 5) if i % 3 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, query string, title string").repartition(12)
    for _ in range(2):
        got = {r.doc_id: r for r in LT.score_pairs(df, Scorer(), batch=8).withColumn("p", LT.penalty("outputs")).collect()}
    for q, d, query, title in rows:
        want = [("E", len(query) / 10), ("I", len(title or "") / 100)] if query else [("S", 0.5)]
        assert [tuple(o) for o in got[d].outputs] == want
        assert abs(got[d].p - (want[1][1] if query else 0.5)) < 1e-12
    loads = open(path).read().split()
    assert len(loads) == len(set(loads)) <= 12


def test_pair_scorer_shares(spark):
    rows = [(i, i, "red bolt", "red bolt" if i % 2 else "blue nut", "E" if i % 2 else "I") for i in range(40)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, query string, title string, label string")
    from quarry.operators import lsa as LSA

    scorer = LT.fit_pair_scorer(df, LSA.Encoder(spark, LSA.fit(df, "title", dim=2)))
    got = {r.title: r for r in LT.score_pairs(df, scorer).withColumn("p", LT.penalty("outputs")).dropDuplicates(["title"]).collect()}
    assert got["red bolt"].outputs[0].token == "E" and got["blue nut"].outputs[0].token == "I"
    assert got["red bolt"].p < 0.1 < 0.8 < got["blue nut"].p


def test_json_files_round_trip(spark):
    from quarry.session import scratch_path
    from quarry.sources import records as REC

    rows = [(1, 'a "b" \n c'), (2, None), (None, ""), (3, "né\t ")]
    df = spark.createDataFrame(rows, "i long, t string")
    path = scratch_path(spark, "json")
    REC.write_json(df.repartition(3), path)
    assert sorted(map(str, REC.read_json(spark, path, df.schema).collect())) == sorted(map(str, df.collect()))
