"""LambdaMART against a brute force over all pairs, its monitor, and a separable ranking."""

import math
import random

from pyspark.sql import functions as F

from quarry.operators import lambdamart as LM
from quarry.operators import ltr as LT

GAIN = {"E": 4, "S": 2, "C": 1, "I": 0}
K = 3


def _rows(seed=3, queries=5, docs=9):
    rng = random.Random(seed)
    rows = []
    for q in range(queries):
        for d in range(docs + q):
            label = rng.choice("ESCI")
            rows.append((q, q * 100 + d, label, float(GAIN[label]) + rng.choice([0.0, 0.5, 1.5]), float(rng.randint(0, 3)), rng.choice([None, 1.0])))
    rows += [(90, 9000 + d, "I", float(d), 0.0, None) for d in range(4)] + [(91, 9100, "E", 1.0, 1.0, 1.0)]
    return rows


def _frame(spark, rows):
    return spark.createDataFrame(rows, "query_id long, doc_id long, label string, f double, g double, h double").repartition(5)


def _ideal(rows, q, k):
    best = sorted((GAIN[r[2]] for r in rows if r[0] == q), reverse=True)[:k]
    return sum(g / math.log2(i + 2) for i, g in enumerate(best))


def _gradients(rows, s, k):
    """Over every pair of a query's documents: the weight is how much swapping them changes nDCG@k."""
    g, h = dict.fromkeys(s, 0.0), dict.fromkeys(s, 0.0)
    for q in {r[0] for r in rows}:
        docs = sorted((r for r in rows if r[0] == q), key=lambda r: (-s[r[1]], r[1]))
        ideal = _ideal(rows, q, k)
        disc = [1 / math.log2(i + 2) if i < k else 0.0 for i in range(len(docs))]
        for a, x in enumerate(docs):
            for b, y in enumerate(docs):
                if GAIN[x[2]] <= GAIN[y[2]] or not ideal:
                    continue
                weight = (GAIN[x[2]] - GAIN[y[2]]) * abs(disc[a] - disc[b]) / ideal
                rho = 1 / (1 + math.exp(s[x[1]] - s[y[1]]))
                g[x[1]] -= rho * weight
                g[y[1]] += rho * weight
                h[x[1]] += rho * (1 - rho) * weight
                h[y[1]] += rho * (1 - rho) * weight
    return g, h


def _ndcg(rows, s, k):
    out = []
    for q in {r[0] for r in rows}:
        docs = sorted((r for r in rows if r[0] == q), key=lambda r: (-s[r[1]], r[1]))[:k]
        if _ideal(rows, q, k):
            out.append(sum(GAIN[r[2]] / math.log2(i + 2) for i, r in enumerate(docs)) / _ideal(rows, q, k))
    return sum(out) / len(out)


def _tree(rows, g, h, cuts, depth, l2, least):
    """The value that each document gets from one greedily grown tree."""
    value = {}

    def leaf(part):
        return sum(g[r[1]] for r in part), sum(h[r[1]] for r in part)

    def split(part, level):
        total = leaf(part)
        best = (1e-9, None, None)
        for f in range(3):
            for c in cuts[f] if level < depth else []:
                left = [r for r in part if (r[3 + f] or 0.0) <= c]
                right = [r for r in part if (r[3 + f] or 0.0) > c]
                (gl, hl), (gr, hr) = leaf(left), leaf(right)
                if hl < least or hr < least:
                    continue
                gain = round(gl * gl / (hl + l2) + gr * gr / (hr + l2) - total[0] ** 2 / (total[1] + l2), 7)
                if gain > best[0]:
                    best = gain, left, right
        if best[1] is None:
            for r in part:
                value[r[1]] = -total[0] / (total[1] + l2)
        else:
            split(best[1], level + 1)
            split(best[2], level + 1)

    split(rows, 0)
    return value


def test_gradients_equal_all_pairs(spark):
    rows = _rows()
    rng = random.Random(1)
    s = {r[1]: rng.choice([0.0, 0.3, -1.0, 2.0]) for r in rows}
    df = LM.gain_and_ideal(_frame(spark, rows), K)
    scores = spark.createDataFrame(list(s.items()), "doc_id long, s double")
    got = {r.doc_id: r for r in LM.lambdas(df.join(scores, "doc_id").drop("f", "h", "g"), K).collect()}
    g, h = _gradients(rows, s, K)
    assert set(got) == set(s)
    for i in s:
        assert abs(got[i].g / 1e9 - g[i]) < 1e-7 and abs(got[i].h / 1e9 - h[i]) < 1e-7
    for q, k in ((0, K), (91, 1)):
        ranks = sorted((got[r[1]].r, r[1]) for r in rows if r[0] == q and got[r[1]].r)
        order = sorted((r for r in rows if r[0] == q), key=lambda r: (-s[r[1]], r[1]))
        assert ranks == [(i + 1, r[1]) for i, r in enumerate(order[:k])]


def test_two_rounds_equal_brute_force(spark):
    rows, valid = _rows(), _rows(seed=8, queries=2)
    valid = [(q + 40, d + 50_000, *rest) for q, d, *rest in valid if q < 40]
    df, vf = _frame(spark, rows), _frame(spark, valid)
    model = LM.fit(df, ["f", "g", "h"], rounds=2, rate=0.5, depth=3, k=K, bins=8, valid=vf)
    cuts = LM.cut_points(df, ["f", "g", "h"], 8)
    s, sv = {r[1]: 0.0 for r in rows}, {r[1]: 0.0 for r in valid}
    history = [(0, _ndcg(rows, s, K), _ndcg(valid, sv, K))]
    for n in range(2):
        g, h = _gradients(rows, s, K)
        moved = _tree(rows, g, h, cuts, 3, 0.1, 1e-3)
        s = {i: s[i] + 0.5 * moved[i] for i in s}
        got = {r.doc_id: r.score for r in LM.score(model.upto(n + 1), df).collect()}
        assert max(abs(got[i] - s[i]) for i in s) < 1e-5
        sv = {r.doc_id: r.score for r in LM.score(model.upto(n + 1), vf).collect()}
        history.append((n + 1, _ndcg(rows, got, K), _ndcg(valid, sv, K)))
    assert len(model.history) == 3
    for got, want in zip(model.history, history, strict=True):
        assert got[0] == want[0] and abs(got[1] - want[1]) < 1e-9 and abs(got[2] - want[2]) < 1e-9
    best = max(v for _, _, v in history)
    assert abs(history[model.best_round][2] - best) < 1e-9


def test_separable_ranking_at_least_as_good_as_softmax_trees(spark):
    rng = random.Random(3)
    rows = []
    for q in range(6):
        for d in range(12):
            label = rng.choice("ESCI")
            rows.append((q, q * 100 + d, label, float(GAIN[label]) + rng.random() * 0.1, rng.random()))
    df = spark.createDataFrame(rows, "query_id long, doc_id long, label string, f double, noise double")
    model = LM.fit(df, ["f", "noise"], rounds=5, rate=0.5, depth=3)
    mine = LT.ndcg_of_scores(LM.score(model, df), df, 10).first()
    trees, rate = LT.fit_listwise_trees(df, ["f", "noise"], rounds=5, rate=0.5, depth=3)
    soft = LT.ndcg_of_scores(LT.listwise_scores(trees, rate, df, ["f", "noise"]), df, 10).first()
    assert mine.mean_ndcg >= soft.mean_ndcg > 0.99 and mine.n_queries == 6
    assert model.importance(1)[0][0] == "f" and abs(sum(v for _, v in model.importance(2)) - 1) < 1e-9


def test_trees_do_not_depend_on_the_deal(spark):
    rows = _rows(seed=5)
    a = LM.fit(_frame(spark, rows), ["f", "g"], rounds=2, depth=2)
    b = LM.fit(_frame(spark, rows).repartition(1), ["f", "g"], rounds=2, depth=2)
    assert a.trees == b.trees


def test_a_pair_never_leaves_its_row(spark):
    """A hot query: no plan node holds more rows than the pairs, the best k and the queries."""
    rows = [(0 if i % 3 else i, i, "ESCI"[i % 4], float(i % 7), 1.0, None) for i in range(600)]
    df = LM.gain_and_ideal(_frame(spark, rows), 10).withColumn("s", F.lit(0.0)).drop("f", "g", "h")
    out = LM.lambdas(df, 10)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and out.count() == 600


def test_a_round_is_few_jobs_without_an_exchange(spark):
    """A hundred rounds have to be cheap: the best k, what the rest gives them, a histogram per level, no shuffle."""
    df, depth = _frame(spark, _rows()), 3
    sc = spark.sparkContext

    def jobs(rounds):
        sc.setJobGroup(f"rounds-{rounds}", "counted")
        LM.fit(df, ["f", "g", "h"], rounds=rounds, depth=depth, k=K, bins=8, valid=df)
        return len(sc.statusTracker().getJobIdsForGroup(f"rounds-{rounds}"))

    try:
        few, more = jobs(1), jobs(4)
    finally:
        sc._jsc.clearJobGroup()
    assert more - few <= 3 * (depth + 2)


def test_scores_written_anew_leave_the_trees_alone(spark, monkeypatch):
    a = LM.fit(_frame(spark, _rows(seed=6)), ["f", "g"], rounds=4, depth=2)
    monkeypatch.setattr(LM, "KEPT", 2)
    b = LM.fit(_frame(spark, _rows(seed=6)), ["f", "g"], rounds=4, depth=2)
    assert a.trees == b.trees
