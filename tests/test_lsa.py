"""The LSA encoder against numpy, and the batch hook's promise to load a model once per worker."""

import os

import numpy as np
import pytest

from conftest import SF001
from quarry.operators import lsa as LSA
from quarry.operators import ltr as LT
from quarry.operators import vector as V
from quarry.sources.tables import read_table


def _dense(texts):
    terms = {}
    df = {}
    for t in texts:
        for w in set(LSA.tokens(t)):
            df[w] = df.get(w, 0) + 1
    for w in sorted(df, key=lambda w: (-df[w], w))[: LSA.FEATURES]:
        terms[w] = len(terms)
    a = np.zeros((len(texts), len(terms)))
    for r, t in enumerate(texts):
        for w in LSA.tokens(t):
            if w in terms:
                a[r, terms[w]] += 1
        at = a[r] > 0
        a[r, at] = 1 + np.log(a[r, at])
    a *= np.log(len(texts) / np.array([df[w] for w in terms])) + 1
    norm = np.linalg.norm(a, axis=1, keepdims=True)
    return terms, a / np.where(norm > 0, norm, 1)


def test_singular_values_and_vectors_equal_numpy(spark):
    docs = read_table(spark, SF001, "documents").select("doc_id", "text")
    texts = [r.text for r in docs.collect()]
    terms, a = _dense(texts)
    model = LSA.fit(docs.repartition(3), "text", dim=16, passes=12)
    assert model.terms == terms
    u, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.abs(model.singular - s[:16]).max() < 1e-3 * s[0]
    assert np.abs(model.singular[:6] - s[:6]).max() < 1e-6
    got = V.embed(docs, "doc_id", "text", LSA.Encoder(spark, model)).toPandas().set_index("doc_id")["embedding"]
    mine = a @ model.vectors
    mine /= np.linalg.norm(mine, axis=1, keepdims=True)
    for r, row in enumerate(docs.collect()):
        assert np.abs(np.array(got[row.doc_id]) - mine[r]).max() < 1e-5


def test_few_texts_nulls_and_unknown_words(spark):
    rows = [(1, "red bolt"), (2, "Red bolt"), (3, None), (4, ""), (5, "blue nut")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = LSA.fit(df, "text", dim=5)
    assert (model.singular[2:] < 1e-6).all() and abs(model.singular[0] - 2**0.5) < 1e-9
    enc = LSA.Encoder(spark, model)
    v = {r.doc_id: np.array(r.embedding) for r in V.embed(df, "doc_id", "text", enc).collect()}
    assert abs(v[1] @ v[2] - 1) < 1e-6 and abs(v[1] @ v[5]) < 1e-6 and not v[3].any() and not v[4].any()
    assert not enc(["other words"])[0].any()
    assert LSA.fit(df.limit(0), "text", dim=3).singular.tolist() == [0, 0, 0]


def test_biencoder_by_the_hook_equals_the_encoder(spark):
    rows = [(1, 1, "red bolt", "Red BOLT"), (1, 2, "red bolt", "blue nut"), (2, 2, "blue", "blue nut"), (2, 4, None, "x"), (3, 5, "red", None)]
    df = spark.createDataFrame(rows, "query_id long, doc_id long, query string, title string")
    enc = LSA.Encoder(spark, LSA.fit(df, "title", dim=3))
    got = {(r.query_id, r.doc_id): r.score for r in LT.biencoder_scores(df, enc).collect()}
    for q, d, query, title in rows:
        assert abs(got[q, d] - float(enc([query])[0] @ enc([title])[0])) < 1e-6
    assert len(got) == 5 and got[1, 1] > 0.99


def test_a_worker_loads_its_model_once(spark, tmp_path):
    path = str(tmp_path / "loads")

    def counting(texts):
        """A double of an encoder that notes in a file each worker that loads it."""
        import quarry.operators.lsa as module

        if not getattr(module, "_loaded", False):
            module._loaded = True
            with open(path, "a") as f:
                f.write(f"{os.getpid()}\n")
        return np.array([[float(len(t or "")), 1.0] for t in texts])

    df = spark.range(3000).selectExpr("id", "repeat('x', CAST(id % 7 AS INT)) AS text").repartition(16)
    for _ in range(2):
        assert V.embed(df, "id", "text", counting, batch=64).count() == 3000
    loads = open(path).read().split()
    assert len(loads) == len(set(loads)) <= 16


@pytest.mark.parametrize("n", [0, 1])
def test_tiny_tables(spark, n):
    df = spark.createDataFrame([(1, "a b")][:n], "doc_id long, text string")
    assert LSA.fit(df, "text", dim=4).vectors.shape[1] == 4


def test_terms_are_counted_in_arrays(monkeypatch):
    """rows equal the definition, and the logarithms of a block of texts are one call, not one per term."""
    calls = []
    log = np.log
    monkeypatch.setattr(LSA.np, "log", lambda x: calls.append(1) or log(x))
    texts = ["b A a  c", None, "", "x y", "C c c b"]
    terms, idf = {"a": 0, "b": 1, "c": 2}, np.array([1.0, 2.0, 3.0])
    columns, rows = LSA.matrix(texts, terms, idf)
    assert len(calls) == 1 and columns.tolist() == [0, 1, 2]
    want = np.array([[1 + log(2), 2, 3], [0, 0, 0], [0, 0, 0], [0, 0, 0], [0, 2, 3 * (1 + log(3))]])
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(rows, want / np.where(norm > 0, norm, 1), rtol=1e-12, atol=0)
    for none in ([], [None], ["x"]):
        columns, rows = LSA.matrix(none, terms, idf)
        assert len(columns) == 0 and rows.shape == (len(none), 0)
