"""Boolean, phrase and clause queries against naive scans of literal documents."""

from quarry.operators import index as I
from quarry.operators import match as M

DOCS = [
    (1, "Information Retrieval and Information Science"),
    (2, "Information Science for kids"),
    (3, "Retrieval of information"),
    (4, "Amazon HDMI Cable 6 ft"),
    (5, "Amazon Basics HDMI Cable"),
    (6, "Cable Amazon HDMI"),
    (7, "Science of Information Science"),
]


def _docs(spark):
    return spark.createDataFrame(DOCS, "doc_id bigint, text string")


def _ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def _has(t, w):
    return w in t.split()


def test_set_operators(spark):
    p = I.build_postings(_docs(spark), "doc_id", "text")
    a, b, c = M.ids(p, "Information"), M.ids(p, "Science"), M.ids(p, "Retrieval")
    assert _ids(M.bool_and(a, b)) == [i for i, t in DOCS if _has(t, "Information") and _has(t, "Science")]
    assert _ids(M.bool_or(a, c)) == [i for i, t in DOCS if _has(t, "Information") or _has(t, "Retrieval")]
    nested = M.bool_and_not(M.bool_or(a, c), M.bool_and(a, b))
    assert _ids(nested) == [
        i for i, t in DOCS if (_has(t, "Information") or _has(t, "Retrieval")) and not (_has(t, "Information") and _has(t, "Science"))
    ]


def _phrase_in(t, ws):
    toks = t.split()
    return any(toks[i : i + len(ws)] == ws for i in range(len(toks) - len(ws) + 1))


def test_phrase_match_equals_scan(spark):
    toks = I.token_table(_docs(spark), "doc_id", "text")
    phrases = {1: ["Information", "Science"], 2: ["HDMI", "Cable"], 3: ["Science"], 4: ["Information", "Science", "for"]}
    got = M.phrase_match(toks, M.phrase_table(spark, phrases)).collect()
    got = sorted((r.query_id, r.doc_id) for r in got)
    exp = sorted((q, i) for q, ws in phrases.items() for i, t in DOCS if _phrase_in(t, ws))
    assert got == exp


def test_clause_builder_precedence_and_tf(spark):
    pos = I.build_positional(_docs(spark), "doc_id", "text")
    clauses = {
        1: M.Or(M.And(M.Word("Amazon"), M.Word("HDMI")), M.Word("Cable")),  # Amazon HDMI OR Cable
        2: M.And(M.Word("Amazon"), M.Or(M.Word("HDMI"), M.Word("Cable"))),  # Amazon ( HDMI OR Cable )
        3: M.And(M.Word("Amazon"), M.phrase("HDMI", "Cable")),  # Amazon " HDMI Cable "
        4: M.phrase("Information", "Science"),
        5: M.AndNot(M.Word("Information"), M.Word("kids")),
    }
    got = {(r.query_id, r.doc_id): r.tf for r in M.bool_query(pos, clauses).collect()}

    def tf(t, w):
        return t.split().count(w)

    exp = {}
    for i, t in DOCS:
        a, h, c = tf(t, "Amazon"), tf(t, "HDMI"), tf(t, "Cable")
        if (a and h) or c:
            exp[(1, i)] = (a + h if a and h else 0) + c
        if a and (h or c):
            exp[(2, i)] = a + h + c
        if a and _phrase_in(t, ["HDMI", "Cable"]):
            exp[(3, i)] = a + h + c
        if _phrase_in(t, ["Information", "Science"]):
            exp[(4, i)] = tf(t, "Information") + tf(t, "Science")
        if tf(t, "Information") and not tf(t, "kids"):
            exp[(5, i)] = tf(t, "Information")
    assert got == exp


def test_all_analyzers_answer_like_a_scan(spark):
    """Differential check: indexes built with different analyzers agree with a token scan."""
    from quarry.functions import text as A

    docs = _docs(spark)
    for name in ("whitespace", "whitespace_lower", "punctuation"):
        an = A.ANALYZERS[name]
        p = I.build_postings(docs, "doc_id", "text", an)
        toks = {i: set(r[0]) for i, r in zip([d[0] for d in DOCS], docs.orderBy("doc_id").select(an(docs.text)).collect())}
        for term in ["Information", "information", "Cable"]:
            assert _ids(M.ids(p, term)) == sorted(i for i, ts in toks.items() if term in ts)
