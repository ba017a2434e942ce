"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import held_out, numbered, utf8

MULT = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(257)
PIECE = 1 << 17  # bytes hashed at a time; n-grams across the cut are kept by overlapping pieces


@dataclass(frozen=True)
class Params:
    """bits: n-grams fall into 2**bits buckets (bounds the model and what counting returns).
    A bucket is a feature if it is in at least ``min_df`` training texts and its log-count ratio is
    at least ``min_ratio`` away from 0. The linear weights are fitted on at most ``fit_rows``
    labelled texts (those with the smallest hashes); the ratios come from all of them."""

    ns: tuple[int, ...] = (3, 4, 5, 6)
    bits: int = 20
    min_df: int = 5
    min_ratio: float = 1.0
    fit_rows: int = 20_000
    epochs: int = 30
    threshold: float = 0.7


def buckets(text: bytes, p: Params) -> Iterator[np.ndarray]:
    """Buckets of the byte n-grams of the text in lower case, with runs of white space as one space,
    piece by piece (a bucket may come more than once)."""
    data = b" " + b" ".join(text.lower().split()) + b" "
    top = max(p.ns)
    for at in range(0, max(1, len(data) - top + 1), PIECE):
        b = np.frombuffer(data[at : at + PIECE + top - 1], np.uint8).astype(np.uint64)
        h = b
        for n in range(2, top + 1):
            if len(b) < n:
                break
            h = h[: len(b) - n + 1] * BASE + b[n - 1 :]
            if n in p.ns:
                yield (((h + np.uint64(n)) * MULT) >> np.uint64(64 - p.bits)).astype(np.int64)


class Distinct:
    """Distinct values of small-integer arrays without sorting or clearing."""

    def __init__(self, size: int):
        self.stamp = np.zeros(size, np.int32)

    def __call__(self, parts: list[np.ndarray]) -> np.ndarray:
        v = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        order = np.arange(len(v), dtype=np.int32)
        self.stamp[v] = order
        return v[self.stamp[v] == order]


def count_buckets(train: DataFrame, p: Params) -> DataFrame:
    """(bucket, pos, neg): how many toxic and other training texts hold each bucket; bucket -1 has
    the numbers of texts. One dense count per task, then a sum by bucket."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = 1 << p.bits
        tally, texts, distinct = np.zeros((2, size), np.int64), np.zeros(2, np.int64), Distinct(size)
        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["toxic"], strict=True):
                tally[int(y)][distinct(list(buckets(text, p)))] += 1
                texts[int(y)] += 1
        if texts.any():
            hit = np.flatnonzero(tally.any(axis=0))
            for part in np.array_split(hit, max(1, len(hit) // 100_000)):
                yield pd.DataFrame({"bucket": part, "pos": tally[1][part], "neg": tally[0][part]})
            yield pd.DataFrame({"bucket": [-1], "pos": [texts[1]], "neg": [texts[0]]})

    counted = train.select("text", "toxic").mapInPandas(count, "bucket long, pos long, neg long")
    return counted.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


@dataclass
class Model:
    params: Params
    weight: np.ndarray  # float32 per bucket: linear weight times log-count ratio, 0: no feature
    norm: np.ndarray  # float32 per bucket: squared ratio, 0: no feature
    bias: float

    def score(self, text: bytes, distinct: Distinct) -> float:
        hits = [h[self.norm[h] > 0] for h in buckets(text, self.params)]
        f = distinct(hits)
        z = float(self.weight[f].sum(dtype=np.float64)) / np.sqrt(max(1.0, float(self.norm[f].sum(dtype=np.float64))))
        return float(1 / (1 + np.exp(-np.clip(z + self.bias, -30, 30))))


def fit(labelled: DataFrame, p: Params = Params()) -> Model:
    """Train on the table of ``labelled_rows``. Without both classes the model returns the
    share of toxic rows (0.5 without rows) for every text."""
    size = 1 << p.bits
    counts = count_buckets(labelled, p)
    totals = counts.where("bucket = -1").first()
    pos, neg = (totals["pos"], totals["neg"]) if totals else (0, 0)
    empty = np.zeros(size, np.float32)
    if not pos or not neg:
        share = pos / (pos + neg) if pos + neg else 0.5
        return Model(p, empty, empty, float(np.log((share + 1e-4) / (1 - share + 1e-4))))
    ratio = F.log((F.col("pos") + 1.0) / (pos + 2.0)) - F.log((F.col("neg") + 1.0) / (neg + 2.0))
    kept = (
        counts.where((F.col("bucket") >= 0) & (F.col("pos") + F.col("neg") >= p.min_df))
        .select("bucket", ratio.alias("ratio"))
        .where(F.abs("ratio") >= p.min_ratio)
        .toPandas()  # at most 2**bits rows
    )
    r = np.zeros(size, np.float64)
    r[kept["bucket"].to_numpy()] = kept["ratio"].to_numpy()
    mask = r != 0

    def select(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        distinct = Distinct(size)
        for pdf in batches:
            f = [distinct([h[mask[h]] for h in buckets(t, p)]).astype(np.int32).tobytes() for t in pdf["text"]]
            yield pd.DataFrame({"f": f, "toxic": pdf["toxic"].to_numpy(np.int32)})

    # the hash below which fit_rows rows lie: only the hashes meet, not the texts
    h = F.xxhash64("_row", "text")
    edge = labelled.select(h.alias("h")).orderBy("h").limit(p.fit_rows).agg(F.max("h")).first()[0]
    chosen = labelled.where(h <= edge)
    sample = chosen.select("text", "toxic").mapInPandas(select, "f binary, toxic int").toPandas()  # at most fit_rows
    rows = [np.frombuffer(f, np.int32) for f in sample["f"]]
    return _descend(rows, sample["toxic"].to_numpy(np.float64), r, p)


def _descend(rows: list[np.ndarray], y: np.ndarray, r: np.ndarray, p: Params) -> Model:
    """Logistic regression by Adagrad over mini-batches of the sparse rows x = ratio / norm, classes
    weighted equally."""
    order = np.lexsort((y, [len(f) for f in rows]))  # the same result whatever order the rows came in
    rows, y = [np.sort(rows[i]) for i in order], y[order]
    at = np.concatenate([[0], np.cumsum([len(f) for f in rows])])
    feat = np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)
    sq = np.add.reduceat(np.append(r[feat] ** 2, 0.0), at[:-1]) * (np.diff(at) > 0) if len(rows) else np.zeros(0)
    val = r[feat] / np.repeat(np.sqrt(np.maximum(1.0, sq)), np.diff(at))
    share = y.mean()
    importance = np.where(y == 1, 0.5 / max(share, 1e-9), 0.5 / max(1 - share, 1e-9))
    w, g2, bias, gb2 = np.zeros(len(r)), np.full(len(r), 1e-6), 0.0, 1e-6
    rng = np.random.default_rng(7)
    for _ in range(p.epochs):
        for batch in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 128)):
            where = np.concatenate([np.arange(at[i], at[i + 1]) for i in batch])
            owner = np.repeat(np.arange(len(batch)), at[batch + 1] - at[batch])
            f, x = feat[where], val[where]
            z = np.bincount(owner, w[f] * x, minlength=len(batch)) + bias
            e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) * importance[batch] / len(batch)
            u, inv = np.unique(f, return_inverse=True)
            g = np.bincount(inv, e[owner] * x, minlength=len(u)) + 1e-7 * w[u]
            g2[u] += g * g
            w[u] -= 0.3 * g / np.sqrt(g2[u])
            gb2 += e.sum() ** 2
            bias -= 0.1 * e.sum() / np.sqrt(gb2)
    return Model(p, (w * r).astype(np.float32), (r * r).astype(np.float32), bias)


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Training rows, written: (text binary, toxic, _row). One label per id (the largest, where labels repeat); null ids
    and labels other than 0 and 1 are left out."""
    y = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IN (0, 1)")
    y = y.where(~held_out("id", 3, 1)).groupBy("id").agg(F.max("toxic").alias("toxic"))
    x = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text")).where("id IS NOT NULL").where(~held_out("id", 3, 1))
    # both sides grow with the corpus: one plan at every size, never a broadcast
    return numbered(x.join(y.hint("merge"), "id").select("text", "toxic"), "labelled")


def score(docs: DataFrame, model: Model, id_col: str, text_col: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per input row: doc_id, the columns of ``carry`` (given once, none named like the
    result's), held_out, score, predicted.

    Whole texts are scored; a null text counts as empty and gets the score of no features. Repeated
    rows get equal scores. The model (two float arrays of 2**bits) goes to each task once.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = shared.value
        distinct = Distinct(1 << m.params.bits)
        for texts in batches:
            yield pd.Series([m.score(t, distinct) for t in texts], dtype="float64")

    kept = F.struct(F.col(id_col).alias("id"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)]).alias("in")
    rows = docs.select(kept, utf8(text_col).alias("b")).withColumn("score", probability("b"))
    carried = [F.col(f"in.c{i}").alias(c) for i, c in enumerate(carry)]
    return rows.select(
        F.col("in.id").alias("doc_id"),
        *carried,
        held_out("in.id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= model.params.threshold).cast("int").alias("predicted"),
    )
