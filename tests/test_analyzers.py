"""Analyzers checked on literal rows against the Python semantics they reproduce."""

import re

from pyspark.sql import functions as F

from quarry.functions import text as A


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_whitespace_matches_python_split(spark):
    vals = ["a b\tc", "  lead and trail  ", "x　y z", "\x1cq\x1fr", "", "one"]
    assert _apply(spark, vals, A.tok_whitespace) == [v.split() for v in vals]


def test_punctuation_keeps_spaces_and_empties(spark):
    vals = ["Hello, world!", "a--b", "!x", "no punct"]
    expected = [re.split(r"[^\w\s]+", v) for v in vals]  # same on these ASCII strings
    assert _apply(spark, vals, A.tok_punctuation) == expected


def test_possessive_filter(spark):
    def py(words):
        out = []
        for w in words:
            if w.endswith("'"):
                out.append(w[:-1])
            elif w.endswith("'s"):
                out.append(w[:-2])
            else:
                out.append(w)
        return out

    vals = ["John's dogs' bone", "it's ''s '", "plain"]
    got = _apply(spark, vals, A.chain(A.tok_whitespace, A.flt_possessive))
    assert got == [py(v.split()) for v in vals]


def test_lowercase_and_stop_terms(spark):
    an = A.chain(A.tok_whitespace, A.flt_lowercase, lambda t: A.flt_stop_terms(t, ["the", "of"]))
    assert _apply(spark, ["The Art OF the Deal"], an) == [["art", "deal"]]


def test_katakana_stem_intent(spark):
    vals = ["コンピューター メモリー カー データ", "ユーザー"]
    got = _apply(spark, vals, A.chain(A.tok_whitespace, A.flt_katakana_stem))
    # one trailing prolonged mark after >= 3 katakana is stripped; the mark itself is not katakana
    # script, so words with an inner mark and short words stay unchanged
    assert got == [["コンピューター", "メモリ", "カー", "データ"], ["ユーザー"]]


def test_as_is(spark):
    assert _apply(spark, ["Amazon Basics"], A.tok_as_is) == [["Amazon Basics"]]
