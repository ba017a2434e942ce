"""Relevance scoring expressions (natural log IDF, BM25 and BM25F weights, label gains)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# BM25 parameters used by the reference's ranking exercises.
BM25_K1 = 1.2
BM25_B = 0.75
BM25F_K1_SWEEP = 3.5
BM25F_TITLE_BOOST = 2.0
BM25F_KEYWORD_BOOST = 1.0

# Graded gains of the shopping-query labels (Exact, Substitute, Complement, Irrelevant).
LABEL_GAIN = {"E": 4, "S": 2, "C": 1, "I": 0}
# Only "I" is non-relevant.
RELEVANT_LABELS = ("E", "S", "C")


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def idf(n_docs, df) -> Column:
    """ln((N - n + 0.5) / (n + 0.5)); negative when a term is in more than half the documents."""
    N, n = _c(n_docs).cast("double"), _c(df).cast("double")
    return F.log((N - n + F.lit(0.5)) / (n + F.lit(0.5)))


def bm25_weight(tf, k1, b, length, avg_length) -> Column:
    tf = _c(tf).cast("double")
    k1, b = _c(k1), _c(b)
    return (tf * (k1 + F.lit(1.0))) / (tf + k1 * (F.lit(1.0) - b + b * _c(length) / _c(avg_length)))


def bm25f_weight(tf, boost, b, length, avg_length) -> Column:
    tf, b = _c(tf).cast("double"), _c(b)
    return tf * _c(boost) / (F.lit(1.0) - b + b * _c(length) / _c(avg_length))


def saturate(weight, k1) -> Column:
    """BM25F per-term saturation w / (K1 + w)."""
    w = _c(weight)
    return w / (_c(k1) + w)


def label_gain(label) -> Column:
    m = F.create_map(*[x for k, v in LABEL_GAIN.items() for x in (F.lit(k), F.lit(v))])
    return m[_c(label)]


def is_relevant(label) -> Column:
    return (_c(label) != F.lit("I")).cast("int")
