"""Learning-to-rank queries over the judged pairs.

Split: test = query_id % 5 = 0; inside train, validation = query_id % 5 = 1 (the reference's
validation rule would select only test queries here, so the next residue is used)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import lambdamart as LM
from quarry.operators import lsa as LSA
from quarry.operators import ltr as LT
from quarry.operators.util import materialize
from quarry.plans import sql as Q
from quarry.plans.registry import register
from quarry.sources.tables import judgments as all_judgments
from quarry.sources.tables import judgments_once as judgments

PAIR_KEYS = "query_id, doc_id"


def _field_sql(short: str, col: str) -> str:
    ws = Q.ws(col)
    bm = Q.bm25_w("tf", "1.2", "0.75", "len", "avg_len")
    return f"""st_{short} AS (SELECT count(*) AS n, sum(CASE WHEN {col} IS NOT NULL THEN len({ws}) ELSE 0 END) / count(*) AS avg_len FROM tr),
df_{short} AS (SELECT term, count(*) AS df FROM (SELECT unnest(list_distinct({ws})) AS term FROM tr WHERE {col} IS NOT NULL) GROUP BY term),
tf_{short} AS (SELECT {PAIR_KEYS}, term, count(*) AS tf FROM (SELECT {PAIR_KEYS}, unnest({ws}) AS term FROM judg WHERE {col} IS NOT NULL)
               GROUP BY {PAIR_KEYS}, term),
len_{short} AS (SELECT {PAIR_KEYS}, CASE WHEN {col} IS NOT NULL THEN len({ws}) ELSE 0 END AS len FROM judg),
rw_{short} AS (SELECT kw.query_id, kw.doc_id, coalesce(t.tf, 0)::DOUBLE AS tf, {Q.idf('s.n', 'coalesce(d.df, 0)')} AS idf, l.len, s.avg_len
               FROM kw LEFT JOIN tf_{short} t USING ({PAIR_KEYS}, term) LEFT JOIN df_{short} d USING (term)
               JOIN len_{short} l USING ({PAIR_KEYS}) CROSS JOIN st_{short} s),
ag_{short} AS (SELECT {PAIR_KEYS},
    sum(tf) AS {short}_tf_sum, avg(tf) AS {short}_tf_avg, var_pop(tf) AS {short}_tf_var,
    sum(tf * idf) AS {short}_tfidf_sum, avg(tf * idf) AS {short}_tfidf_avg, var_pop(tf * idf) AS {short}_tfidf_var,
    sum({bm} * idf) AS {short}_bm25_sum, avg({bm} * idf) AS {short}_bm25_avg, var_pop({bm} * idf) AS {short}_bm25_var
  FROM rw_{short} GROUP BY {PAIR_KEYS})"""


_LEN = {"title_len": "lt.len", "desc_len": "ld.len"}  # the two length features come from the len_* tables
FEATS_SQL = f"""{Q.JUDG}, tr AS (SELECT * FROM judg WHERE split = 'train'),
kw AS (SELECT {PAIR_KEYS}, unnest(range(len(q))) AS qpos, unnest(q) AS term FROM (SELECT {PAIR_KEYS}, {Q.ws('query')} AS q FROM judg)),
{_field_sql('title', 'title')},
{_field_sql('desc', 'description')},
feats AS (SELECT j.query_id, j.doc_id, j.label, j.split, {', '.join(f'{_LEN.get(f, f)}::DOUBLE AS {f}' for f in LT.FEATURES)}
          FROM judg j JOIN len_title lt USING ({PAIR_KEYS}) JOIN len_desc ld USING ({PAIR_KEYS})
          LEFT JOIN ag_title USING ({PAIR_KEYS}) LEFT JOIN ag_desc USING ({PAIR_KEYS}))"""


def _pairs(spark, d):
    return judgments(spark, d)


def _rounded(df):
    return df.select("query_id", "doc_id", "split", *[F.round(f, 6).alias(f) for f in LT.FEATURES])


@register(
    "ltr_corpus_stats",
    f"""WITH {FEATS_SQL}
        SELECT 'title' AS field, n, round(avg_len, 6) AS avg_len, (SELECT count(*) FROM df_title) AS n_terms FROM st_title
        UNION ALL SELECT 'desc', n, round(avg_len, 6), (SELECT count(*) FROM df_desc) FROM st_desc""",
)
def ltr_corpus_stats(spark, d):
    j = _pairs(spark, d)
    train = j.where(F.col("split") == "train")
    out = None
    for short, col in LT.FIELDS.items():
        n, dfs = LT.field_stats(train, col)
        r = n.crossJoin(dfs.agg(F.count(F.lit(1)).alias("n_terms"))).select(
            F.lit(short).alias("field"), "n", F.round("avg_len", 6).alias("avg_len"), "n_terms"
        )
        out = r if out is None else out.unionByName(r)
    return out


@register(
    "ltr_features",
    f"WITH {FEATS_SQL} SELECT query_id, doc_id, split, {', '.join(f'round({f}, 6) AS {f}' for f in LT.FEATURES)} FROM feats",
)
def ltr_features(spark, d):
    return _rounded(LT.features(_pairs(spark, d)))


_MM = ", ".join(f"min({f}) AS mn_{f}, max({f}) AS mx_{f}" for f in LT.FEATURES)
_SC = ", ".join(f"round(CASE WHEN mx_{f} <> mn_{f} THEN ({f} - mn_{f}) / (mx_{f} - mn_{f}) END, 6) AS {f}" for f in LT.FEATURES)


@register(
    "ltr_minmax",
    f"WITH {FEATS_SQL}, mm AS (SELECT {_MM} FROM feats WHERE split = 'train') SELECT query_id, doc_id, split, {_SC} FROM feats CROSS JOIN mm",
)
def ltr_minmax(spark, d):
    return _rounded(LT.minmax(materialize(LT.features(_pairs(spark, d)))))


@register(
    "ltr_train_valid_split",
    f"""WITH {Q.JUDG} SELECT query_id, doc_id,
        CASE WHEN split = 'test' THEN 'test' WHEN query_id % 5 = 1 THEN 'valid' ELSE 'train' END AS part FROM judg""",
)
def ltr_train_valid_split(spark, d):
    j = _pairs(spark, d)
    part = F.when(F.col("split") == "test", "test").when(F.col("query_id") % 5 == 1, "valid").otherwise("train")
    return j.select("query_id", "doc_id", part.alias("part"))


def _scaled(spark, d):
    """Features made once, then scaled, and that checkpointed so the iterative fits do not re-derive it."""
    j = _pairs(spark, d)
    sc = materialize(LT.minmax(materialize(LT.features(j))))
    return j, sc.where(F.col("split") == "train"), sc.where(F.col("split") == "test")


@register("ltr_logistic")
def ltr_logistic(spark, d):
    """Logistic regression on the scaled features: (feature, coefficient) plus the intercept."""
    _, train, _ = _scaled(spark, d)
    m = LT.fit_logistic(train)
    rows = [(f, float(c)) for f, c in zip(LT.FEATURES, m.coefficients.toArray())] + [("intercept", float(m.intercept))]
    return spark.createDataFrame(rows, "feature string, coefficient double")


@register("ltr_rank_logistic")
def ltr_rank_logistic(spark, d):
    """Test pairs ranked by log P(relevant): mean nDCG@10."""
    j, train, test = _scaled(spark, d)
    return LT.ndcg_of_scores(LT.logistic_scores(LT.fit_logistic(train), test), j)


ROUNDS = 100  # trees of the registered rankers: the default of the fit


def _parts(train):
    """The training queries and, apart, the validation ones, which only monitor."""
    valid = F.col("query_id") % 5 == 1
    return train.where(~valid), train.where(valid)


@register("ltr_rank_trees")
def ltr_rank_trees(spark, d):
    """LambdaMART: mean nDCG@10 on the test pairs."""
    j, train, test = _scaled(spark, d)
    return LT.ndcg_of_scores(LM.score(LM.fit(train, LT.FEATURES, rounds=ROUNDS), test), j)


_MODELS: dict[tuple[str, str], LM.Model] = {}


def _monitored(spark, d):
    """(judged pairs, test, training and validation pairs, the model of a monitored training). Queries of a
    session that start from this model share one training."""
    j, train, test = _scaled(spark, d)
    part, valid = _parts(train)
    key = (spark.sparkContext.applicationId, d)
    if key not in _MODELS:
        _MODELS[key] = LM.fit(part, LT.FEATURES, rounds=ROUNDS, rate=0.03, valid=valid)
    return j, test, part, valid, _MODELS[key]


def _history(spark, model):
    """The model's history as rows; metrics are null for a part without judged gains."""
    rounded = [(r, *(None if x is None else round(x, 6) for x in means)) for r, *means in model.history]
    return spark.createDataFrame(rounded, "round int, train_ndcg double, valid_ndcg double")


@register("ltr_train_monitored")
def ltr_train_monitored(spark, d):
    """LambdaMART with its nDCG@10 on the training and the validation queries after every round."""
    return _history(spark, _monitored(spark, d)[-1])


@register(
    "ltr_monitor_start",
    f"""WITH {Q.JUDG}, g AS (SELECT query_id, doc_id, query_id % 5 = 1 AS v,
            CASE label WHEN 'E' THEN 4 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END AS gain FROM judg WHERE split = 'train'),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY doc_id) AS a,
                     row_number() OVER (PARTITION BY query_id ORDER BY gain DESC) AS b FROM g),
        nd AS (SELECT query_id, v, sum(CASE WHEN a <= 10 THEN gain / log2(a + 1) ELSE 0 END) / sum(CASE WHEN b <= 10 THEN gain / log2(b + 1) ELSE 0 END) AS x
               FROM r GROUP BY query_id, v HAVING sum(gain) > 0)
        SELECT 0 AS round, round(avg(CASE WHEN NOT v THEN x END), 6) AS train_ndcg, round(avg(CASE WHEN v THEN x END), 6) AS valid_ndcg FROM nd""",
)
def ltr_monitor_start(spark, d):
    """Round 0 of the monitored training: no tree, all scores equal."""
    _, train, _ = _scaled(spark, d)
    part, valid = _parts(train)
    return _history(spark, LM.fit(part, LT.FEATURES, rounds=0, valid=valid))


@register("ltr_best_round")
def ltr_best_round(spark, d):
    """The round with the best validation nDCG of a monitored training, and the test nDCG@10 of that many
    trees and of all."""
    j, test, _, _, model = _monitored(spark, d)
    out = None
    for rounds in (model.best_round, ROUNDS):
        row = LT.ndcg_of_scores(LM.score(model.upto(rounds), test), j).select(F.lit(rounds).alias("trees"), "mean_ndcg", "n_queries")
        out = row if out is None else out.unionByName(row)
    return out


@register("ltr_top_features")
def ltr_top_features(spark, d):
    """The 10 most important features of LambdaMART trees trained beside a validation split."""
    model = _monitored(spark, d)[-1]
    return spark.createDataFrame([(i + 1, f, v) for i, (f, v) in enumerate(model.importance(10))], "rank int, feature string, importance double")


@register("ltr_retrain_reduced")
def ltr_retrain_reduced(spark, d):
    """Retrain on the 10 most important features only; mean nDCG@10 on test."""
    j, test, part, valid, model = _monitored(spark, d)
    reduced = LM.fit(part, [f for f, _ in model.importance(10)], rounds=ROUNDS, rate=0.03, valid=valid)
    return LT.ndcg_of_scores(LM.score(reduced, test), j)


@register("ltr_model_rerank")
def ltr_model_rerank(spark, d):
    """Re-rank test pairs by the penalty of a trained label model's best three outputs (ascending):
    mean nDCG@10."""
    j, train, test = _scaled(spark, d)
    scored = LT.label_outputs(LT.fit_label_model(train), test).withColumn("score", LT.penalty("outputs"))
    return LT.ndcg_of_scores(scored, j, ascending=True)


@register("ltr_scorer_rerank")
def ltr_scorer_rerank(spark, d):
    """Re-rank test pairs by the penalty of a batch scorer's outputs, fitted on the training pairs: mean
    nDCG@10."""
    j = _pairs(spark, d)
    train = j.where("split = 'train'")
    encoder = LSA.Encoder(spark, LSA.fit(train.select("title"), "title"))
    scored = LT.score_pairs(j.where("split = 'test'"), LT.fit_pair_scorer(train, encoder))
    return LT.ndcg_of_scores(scored.withColumn("score", LT.penalty("outputs")), j, ascending=True)


@register("ltr_biencoder_rerank")
def ltr_biencoder_rerank(spark, d):
    """Bi-encoder cosine between each distinct query (encoded once) and the titles, by an encoder fitted on
    the training titles: mean nDCG@10."""
    j = materialize(all_judgments(spark, d).drop("description"))  # which nothing reads here
    encoder = LSA.Encoder(spark, LSA.fit(j.where("split = 'train'").select("title"), "title"))
    return LT.ndcg_of_scores(LT.biencoder_scores(j.where("split = 'test'"), encoder), j)


@register("ltr_rank_listwise")
def ltr_rank_listwise(spark, d):
    """Listwise boosted trees with deep steps: mean nDCG@10 on the validation pairs, which no tree saw."""
    j, train, _ = _scaled(spark, d)
    part, valid = _parts(train)
    fitted = LT.fit_listwise_trees(part, rounds=8, rate=0.5, depth=4)
    return LT.ndcg_of_scores(LT.listwise_scores(*fitted, valid), j)
