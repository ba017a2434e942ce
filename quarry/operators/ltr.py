"""Learning to rank: lexical features per judged pair, scaling, and MLlib models.

Corpus statistics come from the TRAINING pairs (a document judged for three queries counts
three times; null fields count in N and in the average-length denominator) and are reused for
test pairs. Query keywords keep duplicates (posexplode), so a repeated keyword repeats its
feature values.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import scoring as S
from quarry.functions.text import tok_whitespace
from quarry.operators import evaluate as E
from quarry.operators.index import let
from quarry.operators.util import one_row

# The 20 feature names, in the reference's order.
FEATURES = [
    "title_tf_sum", "title_tf_avg", "title_tf_var",
    "title_tfidf_sum", "title_tfidf_avg", "title_tfidf_var",
    "title_bm25_sum", "title_bm25_avg", "title_bm25_var",
    "desc_tf_sum", "desc_tf_avg", "desc_tf_var",
    "desc_tfidf_sum", "desc_tfidf_avg", "desc_tfidf_var",
    "desc_bm25_sum", "desc_bm25_avg", "desc_bm25_var",
    "title_len", "desc_len",
]
FIELDS = {"title": "title", "desc": "description"}
PAIR = ["query_id", "doc_id"]


def field_stats(train: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """(one row: n, avg_len) and (term, df) over the training pairs."""
    toks = tok_whitespace(col)
    n = train.agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(F.when(F.col(col).isNotNull(), F.size(toks)).otherwise(0)) / F.count(F.lit(1))).alias("avg_len"),
    )
    dfs = train.where(F.col(col).isNotNull()).select(F.explode(F.array_distinct(toks)).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("df")
    )
    return n, dfs


def keyword_rows(pairs: DataFrame) -> DataFrame:
    """One row per pair and query keyword (repeats kept, none for an empty query: one null row) with
    the keyword's tf in each field, counted within the pair's row, and the fields' lengths."""
    def tokens(col):
        return F.coalesce(tok_whitespace(col), F.array().cast("array<string>"))

    def of(held):
        lens = [F.size(held[s]).alias(f"{s}_len") for s in FIELDS]
        tfs = lambda w: [(F.size(held[s]) - F.size(F.array_remove(held[s], w))).cast("double").alias(f"{s}_tf") for s in FIELDS]
        return F.struct(*lens, F.transform(held["q"], lambda w: F.struct(w.alias("term"), *tfs(w))).alias("kws"))

    held = F.struct(tokens("query").alias("q"), *[tokens(c).alias(s) for s, c in FIELDS.items()])
    rows = pairs.select(*PAIR, "label", "split", let(held, of).alias("r"))
    rows = rows.select(*PAIR, "label", "split", *[f"r.{s}_len" for s in FIELDS], F.explode_outer("r.kws").alias("k"))
    return rows.select(*PAIR, "label", "split", *[f"{s}_len" for s in FIELDS], "k.*")


def keyword_dfs(train: DataFrame, keywords: DataFrame) -> DataFrame:
    """(term, title_df, desc_df) over the training pairs, of the keywords only."""
    def marked(short):
        distinct = F.array_distinct(F.coalesce(tok_whitespace(FIELDS[short]), F.array().cast("array<string>")))
        return F.transform(distinct, lambda w: F.struct(w.alias("term"), *[F.lit(int(short == o)).alias(f"{o}_df") for o in FIELDS]))

    marks = [marked(short) for short in FIELDS]
    terms = train.select(F.explode(F.concat(*marks)).alias("m")).select("m.*")
    return terms.join(keywords.select("term").distinct(), "term").groupBy("term").agg(*[F.sum(f"{s}_df").alias(f"{s}_df") for s in FIELDS])


def features(pairs: DataFrame) -> DataFrame:
    """Pairs (query_id, doc_id, query, title, description, label, split) + the 20 features: one join
    to the document frequencies and one aggregate per pair for both fields."""
    train = pairs.where(F.col("split") == "train")
    keywords = pairs.select("query").distinct().select(F.explode(tok_whitespace("query")).alias("term"))
    sizes = [F.when(F.col(c).isNotNull(), F.size(tok_whitespace(c))).otherwise(0) for c in FIELDS.values()]
    n = F.count(F.lit(1))
    stats = train.agg(n.alias("n"), *[(F.sum(x) / n).alias(f"{s}_avg") for s, x in zip(FIELDS, sizes, strict=True)])
    rows = keyword_rows(pairs).join(keyword_dfs(train, keywords), "term", "left").crossJoin(one_row(stats))
    aggs = []
    for s in FIELDS:
        idf = S.idf("n", F.coalesce(f"{s}_df", F.lit(0)))
        tf = F.col(f"{s}_tf")
        bm25 = S.bm25_weight(f"{s}_tf", S.BM25_K1, S.BM25_B, f"{s}_len", f"{s}_avg") * idf
        for name, x in (("tf", tf), ("tfidf", tf * idf), ("bm25", bm25)):
            aggs += [F.sum(x).alias(f"{s}_{name}_sum"), F.avg(x).alias(f"{s}_{name}_avg"), F.var_pop(x).alias(f"{s}_{name}_var")]
    per_pair = rows.groupBy(*PAIR, "label", "split", *[f"{s}_len" for s in FIELDS]).agg(*aggs)
    return per_pair.select(*PAIR, "label", "split", *[F.col(f).cast("double").alias(f) for f in FEATURES])


def minmax(feats: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """(x - min) / (max - min) with training min and max; a constant feature gives null."""
    mm = feats.where(F.col("split") == "train").agg(*[F.min(c).alias(f"_min_{c}") for c in cols], *[F.max(c).alias(f"_max_{c}") for c in cols])
    j = feats.crossJoin(one_row(mm))
    scaled = [
        F.when(F.col(f"_max_{c}") != F.col(f"_min_{c}"), (F.col(c) - F.col(f"_min_{c}")) / (F.col(f"_max_{c}") - F.col(f"_min_{c}"))).alias(c)
        for c in cols
    ]
    keep = [c for c in feats.columns if c not in cols]
    return j.select(*keep, *scaled)


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """Dense feature vector; nulls (constant features, empty queries) become 0."""
    from pyspark.ml.feature import VectorAssembler

    filled = df.fillna(0.0, subset=cols)
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(filled)


def fit_logistic(train: DataFrame, cols: list[str] = FEATURES):
    """Binary relevance (I = 0, else 1); L2 with C = 1 as regParam = 1/n, no standardisation."""
    from pyspark.ml.classification import LogisticRegression

    data = assemble(train, cols).withColumn("y", S.is_relevant("label").cast("double"))
    n = data.count()
    lr = LogisticRegression(featuresCol="features", labelCol="y", regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False, maxIter=10000)
    return lr.fit(data)


def logistic_scores(model, test: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    """Log-probability of the relevant class as the ranking score."""
    from pyspark.ml.functions import vector_to_array

    pred = model.transform(assemble(test, cols))
    return pred.withColumn("score", F.log(vector_to_array("probability")[1])).drop("features", "rawPrediction", "probability", "prediction")


def ndcg_of_scores(scored: DataFrame, judg: DataFrame, k: int = 10, ascending: bool = False) -> DataFrame:
    """Rank pairs by score (desc, ties: smaller id; or ascending) and return mean nDCG@k."""
    from quarry.operators import rank as R

    s = scored.withColumn("_s", -F.col("score") if ascending else F.col("score"))
    r = R.topk_batch(s, "query_id", k, score="_s", ties="asc").withColumn("system", F.lit("model"))
    nd = E.ndcg_at_k(r.select("system", "query_id", "doc_id", "label", "rank"), judg, k)
    return nd.agg(F.avg("ndcg").alias("mean_ndcg"), F.count(F.lit(1)).alias("n_queries"))


def top_features(trees, cols: list[str], k: int = 10) -> list[tuple[str, float]]:
    """The k most important features over all trees (ties: later name first, as a max-heap of
    (importance, name))."""
    imp = sum(t.featureImportances.toArray() for t in trees) / max(1, len(trees))
    return [(n, float(v)) for v, n in sorted(zip(imp, cols, strict=True), reverse=True)[:k]]


# ---- model scores over text pairs -------------------------------------------------------------

LABELS = ["I", "C", "S", "E"]  # class numbers of the label model


def fit_label_model(train: DataFrame, cols: list[str] = FEATURES):
    """Multinomial logistic regression of the four labels on the lexical features."""
    from pyspark.ml.classification import LogisticRegression

    y = F.array_position(F.array(*[F.lit(x) for x in LABELS]), F.col("label")) - 1
    data = assemble(train, cols).withColumn("y", y.cast("double"))
    return LogisticRegression(featuresCol="features", labelCol="y", family="multinomial", regParam=0.01, maxIter=200).fit(data)


def label_outputs(model, pairs: DataFrame, cols: list[str] = FEATURES, n: int = 3) -> DataFrame:
    """Pairs plus ``outputs``: the model's n likeliest labels as (token, score), best first."""
    from pyspark.ml.functions import vector_to_array

    p = model.transform(assemble(pairs, cols)).withColumn("_p", vector_to_array("probability"))
    seen = F.transform("_p", lambda x, i: F.struct(x.alias("score"), F.get(F.array(*[F.lit(t) for t in LABELS]), i).alias("token")))
    out = p.withColumn("outputs", F.slice(F.reverse(F.array_sort(seen)), 1, n))
    return out.drop("features", "rawPrediction", "probability", "prediction", "_p")


def penalty(outputs: Column | str) -> Column:
    """Penalty of a pair from a scorer's (token, score) outputs: the score of token "I" if it is among
    them, else the least score returned, 1 without any output."""
    outputs = F.col(outputs) if isinstance(outputs, str) else outputs
    hit = F.filter(outputs, lambda x: x["token"] == "I")
    least = F.array_min(F.transform(outputs, lambda x: x["score"]))
    return F.coalesce(F.get(hit, 0)["score"], least, F.lit(1.0))


OUTPUTS = "array<struct<token: string, score: double>>"
SCORER_BATCH = 16
COSINE_DIGITS = 5  # cosines of one pair may differ beyond these between the JVM and numpy
_LOADED: dict[str, object] = {}  # the scorer that a worker has loaded


def score_pairs(pairs: DataFrame, scorer, batch: int = SCORER_BATCH, out: str = "outputs") -> DataFrame:
    """Pairs plus ``out``, the (token, score) outputs of a scorer of one's own for their query and title.

    ``scorer.key`` names it, ``scorer.load()`` gives a function of a list of queries and one of titles that
    returns a list of (token, score) lists. A worker loads it once, whatever tasks it runs, and calls it on
    batches of ``batch`` pairs. Nulls arrive as empty strings."""
    import pyarrow as pa

    kind = pa.list_(pa.struct([("token", pa.string()), ("score", pa.float64())]))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        from quarry.operators import ltr as own

        model = own._LOADED.get(scorer.key)
        if model is None:
            own._LOADED.clear()
            model = own._LOADED[scorer.key] = scorer.load()
        for queries, titles in batches:
            q, t = ([x or "" for x in a.to_pylist()] for a in (queries, titles))
            found = [o for at in range(0, len(q), batch) for o in model(q[at : at + batch], t[at : at + batch])]
            yield pa.array([[{"token": k, "score": float(v)} for k, v in o] for o in found], kind)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    # as a projection of its own: the texts are plain columns when the scorer is planned
    return pairs.withColumn(out, F.arrow_udf(run, OUTPUTS)(F.col("query"), F.col("title")))


class PairScorer:
    """Likeliest labels of a (query, title) pair: the labels' shares among training pairs of like cosine."""

    def __init__(self, key: str, encoder, cuts: list[float], shares: list[list[float]], n: int = 3):
        self.key, self.encoder, self.cuts, self.shares, self.n = key, encoder, cuts, shares, n

    def load(self):
        import numpy as np

        best = [sorted(zip(LABELS, p, strict=True), key=lambda x: (-x[1], x[0]))[: self.n] for p in self.shares]

        def outputs(queries: list[str], titles: list[str]) -> list[list[tuple[str, float]]]:
            cosine = np.round((self.encoder(queries) * self.encoder(titles)).sum(axis=1), COSINE_DIGITS)
            return [best[i] for i in np.searchsorted(self.cuts, cosine)]

        return outputs


def fit_pair_scorer(train: DataFrame, encoder, bins: int = 10) -> PairScorer:
    """Label shares (one pseudo-count each) in ``bins`` quantile bins of the pairs' cosine: one aggregate."""
    scored = biencoder_scores(train, encoder).select("label", F.round("score", COSINE_DIGITS).alias("score"))
    cuts = sorted(set(scored.approxQuantile("score", [i / bins for i in range(1, bins)], 0.001)))
    place = F.aggregate(F.array(*[F.lit(c) for c in cuts]), F.lit(0), lambda n, c: n + (c < F.col("score")).cast("int")) if cuts else F.lit(0)
    counts = [[1.0] * len(LABELS) for _ in range(len(cuts) + 1)]
    for r in scored.groupBy(place.alias("bin"), "label").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[r["bin"]][LABELS.index(r["label"])] += r["n"]
    shares = [[c / sum(row) for c in row] for row in counts]
    return PairScorer(f"pairs-{hash((tuple(cuts), tuple(map(tuple, shares))))}", encoder, cuts, shares)


def encode(df: DataFrame, text_col: str, out: str, dim: int = 64) -> DataFrame:
    """``out``: the text's lower-cased tokens hashed into ``dim`` features, length 1 (MLlib, JVM-side)."""
    from pyspark.ml.feature import HashingTF, Normalizer
    from pyspark.ml.functions import vector_to_array

    tokens = F.coalesce(F.transform(tok_whitespace(text_col), F.lower), F.array().cast("array<string>"))
    hashed = HashingTF(numFeatures=dim, inputCol="_tokens", outputCol="_hashed").transform(df.withColumn("_tokens", tokens))
    unit = Normalizer(p=2.0, inputCol="_hashed", outputCol="_unit").transform(hashed)
    return unit.withColumn(out, vector_to_array("_unit")).drop("_tokens", "_hashed", "_unit")


def biencoder_scores(pairs: DataFrame, encoder=None) -> DataFrame:
    """Cosine of query and title vectors. Each DISTINCT query, and each document once, is encoded: by
    ``encoder`` (a list of texts to a matrix of rows of length 1) through the batch hook, or else by hashing. A
    null or empty side has cosine 0."""
    from quarry.functions import vectors as VF
    from quarry.operators import vector as V

    queries = pairs.select("query").distinct()
    if encoder is None:
        qv = encode(queries, "query", "qv")
        j = encode(pairs, "title", "tv").join(qv.withColumnRenamed("query", "_q"), F.col("query").eqNullSafe(F.col("_q")))
        return j.withColumn("score", VF.dot("tv", "qv")).drop("tv", "qv", "_q")
    # the hook keys its vectors: queries by their text, titles by their document
    qv = V.embed(queries.withColumn("_t", F.col("query")), "query", "_t", encoder).select(F.col("query").alias("_q"), F.col("embedding").alias("qv"))
    titles = pairs.groupBy("doc_id").agg(F.max("title").alias("title"))
    tv = V.embed(titles, "doc_id", "title", encoder).withColumnRenamed("embedding", "tv")
    j = pairs.join(tv, "doc_id").join(qv, F.col("query").eqNullSafe(F.col("_q")))
    return j.withColumn("score", VF.dot("tv", "qv")).drop("tv", "qv", "_q")


# ---- listwise boosted trees ------------------------------------------------------------------


def _per_query(df: DataFrame, agg, name: str) -> DataFrame:
    """Join a per-query aggregate back (one row per query; AQE picks broadcast or a skew-split join)."""
    return df.join(df.groupBy("query_id").agg(agg.alias(name)), "query_id")


def fit_listwise_trees(train: DataFrame, cols: list[str] = FEATURES, rounds: int = 100, rate: float = 0.1, depth: int = 4, seed: int = 0):
    """Gradient boosting on the ListNet (top-one softmax) cross-entropy between the gain
    distribution and the score distribution of each query, exactly ``rounds`` trees.

    The gradient of a document is p_score - p_gain, which needs per-query sums only: no pairs
    of documents are formed, so a query holding a third of the rows costs partial aggregates, not
    a quadratic pair set. Each round fits an MLlib regression tree to the negative gradient and
    the scored table is checkpointed (shared checkpoint folder) to cut the loop's lineage. Scores
    stay below rounds * rate in size, so their exponentials need no shift.
    Returns (trees, rate); score = rate * sum of tree predictions."""
    from pyspark.ml.regression import DecisionTreeRegressor

    from quarry.operators.util import materialize

    base = assemble(train, cols).withColumn("_eg", F.exp(S.label_gain("label").cast("double")))
    base = _per_query(base, F.sum("_eg"), "_gz").withColumn("p_t", F.col("_eg") / F.col("_gz"))
    data = materialize(base.select("query_id", "doc_id", "features", "p_t", F.lit(0.0).alias("s")))
    trees = []
    for _ in range(rounds):
        g = _per_query(data, F.sum(F.exp("s")), "_sz").withColumn("target", F.col("p_t") - F.exp("s") / F.col("_sz"))
        tree = DecisionTreeRegressor(featuresCol="features", labelCol="target", maxDepth=depth, seed=seed).fit(g)
        trees.append(tree)
        moved = tree.transform(data).withColumn("s", F.col("s") + rate * F.col("prediction"))
        data = materialize(moved.select("query_id", "doc_id", "features", "p_t", "s"))
    return trees, rate


def listwise_scores(trees, rate: float, test: DataFrame, cols: list[str] = FEATURES) -> DataFrame:
    out = assemble(test, cols).withColumn("score", F.lit(0.0))
    for t in trees:
        out = t.transform(out).withColumn("score", F.col("score") + rate * F.col("prediction")).drop("prediction")
    return out.drop("features")
