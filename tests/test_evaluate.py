"""Metrics and tests against brute-force Python over small literal rankings."""

import math

from pyspark.sql import functions as F

from quarry.functions.stats import binom_two_sided_p_half, t_two_sided_p
from quarry.operators import evaluate as E

GAIN = {"E": 4, "S": 2, "C": 1, "I": 0}
RANK = {
    1: ["E", "I", "S", "C", "I"],
    2: ["I", "I", "I"],
    3: ["C", "E"] + ["I"] * 12,
}


def _df(spark):
    rows = [("sys", q, q * 100 + n, lab, n + 1) for q, labs in RANK.items() for n, lab in enumerate(labs)]
    return spark.createDataFrame(rows, "system string, query_id long, doc_id long, label string, rank long")


def test_precision_at_k_divides_by_list_length(spark):
    got = E.precision_at_k(_df(spark), 10).first()["p_at_10"]
    exp = sum(sum(l != "I" for l in labs[:10]) / min(10, len(labs)) for labs in RANK.values()) / len(RANK)
    assert abs(got - exp) < 1e-12


def test_map_skips_queries_without_relevant(spark):
    got = E.mean_average_precision(_df(spark).withColumn("score", -F.col("rank")).drop("rank")).first()["map"]
    aps = []
    for labs in RANK.values():
        rel, s = 0, 0.0
        for n, l in enumerate(labs, 1):
            if l != "I":
                rel += 1
                s += rel / n
        if rel:
            aps.append(s / rel)
    assert abs(got - sum(aps) / len(aps)) < 1e-12


def test_ndcg_drops_zero_ideal_and_is_bounded(spark):
    r = _df(spark)
    j = r.drop("rank", "system")
    nd = {x.query_id: x.ndcg for x in E.ndcg_at_k(r, j, 10).collect()}
    assert 2 not in nd
    for q, labs in RANK.items():
        if q == 2:
            continue
        dcg = sum(GAIN[l] / math.log2(n + 1) for n, l in enumerate(labs[:10], 1))
        ideal = sorted(labs, key=lambda l: -GAIN[l])
        idcg = sum(GAIN[l] / math.log2(n + 1) for n, l in enumerate(ideal[:10], 1))
        assert abs(nd[q] - dcg / idcg) < 1e-12 and 0 <= nd[q] <= 1


# The annotator-agreement fixture (queries 2155 and 18440); the second list is invented.
MINE = {
    2155: ["E", "E", "E", "E", "E", "E", "E", "E", "E", "E", "E", "S", "E", "E", "E", "C"],
    18440: ["I", "E", "I", "S", "E", "E", "E", "E", "E", "E", "E", "I", "C", "C", "C", "I"],
}
THEIRS = {
    2155: ["E", "E", "S", "E", "E", "E", "E", "E", "E", "E", "E", "S", "E", "E", "C", "C"],
    18440: ["I", "E", "I", "I", "E", "S", "E", "E", "E", "C", "E", "I", "C", "C", "I", "I"],
}


def _kappa(a, b):
    n = len(a)
    po = sum(x == y for x, y in zip(a, b)) / n
    pe = sum((a.count(l) / n) * (b.count(l) / n) for l in set(a) | set(b))
    return (po - pe) / (1 - pe)


def test_cohen_kappa_fixture(spark):
    rows = [(q, a, b) for q in MINE for a, b in zip(MINE[q], THEIRS[q])]
    df = spark.createDataFrame(rows, "query_id long, label_a string, label_b string")
    got = {r.query_id: r.kappa for r in E.cohen_kappa(df).collect()}
    for q in MINE:
        assert abs(got[q] - _kappa(MINE[q], THEIRS[q])) < 1e-12


def test_paired_t_and_sign_tests(spark):
    a = [0.9, 0.5, 0.7, 0.3, 0.8, 0.6]
    b = [0.8, 0.6, 0.4, 0.2, 0.7, 0.6]
    df = spark.createDataFrame(list(zip(range(6), a, b)), "query_id long, a double, b double")
    t = E.paired_t_test(df).first()
    d = [x - y for x, y in zip(a, b)]
    m = sum(d) / len(d)
    sd = math.sqrt(sum((x - m) ** 2 for x in d) / (len(d) - 1))
    assert abs(t.t - m / (sd / math.sqrt(len(d)))) < 1e-12
    angle = math.atan(t.t / math.sqrt(5))  # the closed form for 5 degrees of freedom
    tail = 1 - 2 / math.pi * (angle + math.sin(angle) * (math.cos(angle) + 2 / 3 * math.cos(angle) ** 3))
    assert abs(t.p_value - tail) < 1e-9
    assert t.mean_diff > 0  # improved (a) minus baseline (b)
    s = E.binomial_sign_test(df).first()
    assert (s.a_wins, s.b_wins) == (4, 1)
    assert abs(s.p_value - 0.375) < 1e-12


def test_distribution_functions_known_values():
    # Student t: two-sided p for t = 2.0, 10 dof is 0.0733880...; t = 0 gives 1
    assert abs(t_two_sided_p(2.0, 10) - 0.07338803477074) < 1e-9
    assert abs(t_two_sided_p(0.0, 5) - 1.0) < 1e-12
    assert abs(binom_two_sided_p_half(10, 12) - 158 / 4096) < 1e-12
    assert binom_two_sided_p_half(3, 6) == 1.0


def test_ks_statistic_equals_brute_force(spark):
    vals = [float(x) / 10 for x in range(-20, 21)] + [0.05, 1.7]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    r = E.ks_normal(df, "v").first()
    cdf = lambda v: 0.5 * math.erfc(-v / math.sqrt(2))
    n = len(vals)
    exp = max(max((i + 1) / n - cdf(v), cdf(v) - i / n) for i, v in enumerate(sorted(vals)))
    assert abs(r.statistic - exp) < 1e-9
    far = spark.createDataFrame([(v + 5,) for v in vals], "v double")
    assert E.ks_normal(far, "v").first().pValue < 1e-6 < r.pValue


def test_paired_t_of_all_pairs_has_the_sign_of_the_later_system(spark):
    rows = [(s, q, v) for s, vs in {"baseline": [0.1, 0.2, 0.3], "tf": [0.4, 0.3, 0.9], "tfidf": [0.5, 0.2, 0.8]}.items() for q, v in enumerate(vs)]
    got = {(r.system_a, r.system_b): r for r in E.paired_t_by_pair(spark.createDataFrame(rows, "system string, query_id long, ndcg double")).collect()}
    assert set(got) == {("tf", "baseline"), ("tfidf", "baseline"), ("tfidf", "tf")}
    r = got["tf", "baseline"]
    assert r.n == 3 and abs(r.mean_diff - 1.0 / 3) < 1e-12  # (0.3 + 0.1 + 0.6) / 3
    sd = math.sqrt(sum((d - 1 / 3) ** 2 for d in (0.3, 0.1, 0.6)) / 2)
    assert abs(r.t - (1 / 3) / (sd / math.sqrt(3))) < 1e-9
    p = E.with_t_p_value(spark.createDataFrame([(3, 0.1, 2.0)], "n long, mean_diff double, t double")).first().p_value
    assert abs(p - 0.183503) < 1e-6  # t = 2 with 2 degrees of freedom: 1 - 2 / sqrt(6)


def test_ks_normal_ranks_once(spark, monkeypatch):
    """MLlib's test runs several jobs for each system; what they read is made once."""
    from quarry.plans import eval_plans

    made = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(s, q, (q % 7) / 7.0) for s in ("baseline", "tf") for q in range(30)], "system string, query_id long, ndcg double")

    def counted(batches):
        for pdf in batches:
            made.add(len(pdf))
            yield pdf

    monkeypatch.setattr(eval_plans, "_ndcg", lambda spark, d: rows.mapInPandas(counted, rows.schema))
    out = eval_plans.test_ks_normal(spark, "").collect()
    assert {r.system for r in out} == {"baseline", "tf"} and made.value == 60


def test_ks_normal_tests_every_system(spark, tmp_path):
    """Each system that is scored has its row: the statistic of its own nDCG, by a brute force from the tables."""
    from quarry.plans import eval_plans

    queries = {q: f"red shoe w{q}" for q in range(1, 8)}
    titles = ["red red hat", "w{q} lamp", "shoe", "red shoe w{q}", "green hat"]  # tf and tfidf order them apart
    docs, labels = [], []
    for q in queries:
        for n, title in enumerate(titles):
            doc = 100 * q + n
            docs.append((doc, title.format(q=q), "us", f"source{q}", len(title)))
            labels.append((doc, (n + q) % 2, (n * q) % 3 % 2))
    # titles of no judged pair, so that red and shoe are common and w1 to w7 rare
    docs += [(9000 + n, "red shoe of another", "us", "none", 19) for n in range(60)]
    tables = {
        "documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"),
        "labels": (labels, "doc_id long, quality int, toxic int"),
        "benchmark": (list(queries.items()), "item_id long, text string"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    df = {}
    for _, text, *_ in docs:
        for w in set(text.split()):
            df[w] = df.get(w, 0) + 1
    idf = lambda w: math.log((len(docs) - df[w] + 0.5) / (df[w] + 0.5))
    score = {
        "baseline": lambda words, held: 0,
        "tf": lambda words, held: sum(w in held for w in words),
        "tfidf": lambda words, held: sum(words.count(w) * idf(w) for w in held if w in words),
    }
    label = {doc: {(1, 0): 4, (1, 1): 2, (0, 0): 1, (0, 1): 0}[quality, toxic] for doc, quality, toxic in labels}
    dcg = lambda gains: sum(g / math.log2(r + 1) for r, g in enumerate(gains, 1))
    cdf = lambda v: 0.5 * math.erfc(-v / math.sqrt(2))
    exp = {}
    for s, fn in score.items():
        x = []
        for q, held in queries.items():
            pairs = [(doc, fn(text.split(), set(held.split()))) for doc, text, _, source, _ in docs if source == f"source{q}"]
            ranked = [label[doc] for doc, _ in sorted(pairs, key=lambda p: (-p[1], p[0]))]
            x.append(dcg(ranked) / dcg(sorted(ranked, reverse=True)))
        exp[s] = max(max((i + 1) / len(x) - cdf(v), cdf(v) - i / len(x)) for i, v in enumerate(sorted(x)))
    assert len(set(exp.values())) == 3

    got = eval_plans.test_ks_normal(spark, str(tmp_path)).collect()
    assert [r.system for r in got] == ["baseline", "tf", "tfidf"]
    for r in got:
        assert abs(r.statistic - exp[r.system]) < 1e-9 and 0 < r.pValue < 0.05


def test_ks_normal_without_judged_pairs(spark, monkeypatch):
    """No nDCG at all: a row for every system, as MLlib gives it for no values."""
    from quarry.plans import eval_plans

    none = spark.createDataFrame([], "system string, query_id long, ndcg double")
    monkeypatch.setattr(eval_plans, "_ndcg", lambda spark, d: none)
    assert [(r.system, r.pValue) for r in eval_plans.test_ks_normal(spark, "").collect()] == [(s, 1.0) for s in ("baseline", "tf", "tfidf")]
