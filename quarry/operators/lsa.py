"""Latent semantic analysis: a text encoder from a distributed truncated SVD of the tf-idf rows.

The rows are texts, the columns the ``features`` most frequent terms; a row holds (1 + ln tf) * idf of its
terms, scaled to length 1. The right singular vectors come from randomised subspace iteration: a pass
over the texts multiplies a block of a few dozen columns by A'A, tasks adding up what their rows give, one
line per term. Terms by columns is what the driver and a task hold, whatever the number of texts is.
The matrix itself is never built: each pass reads and tokenizes the texts.

A text is encoded as its row times the singular vectors, scaled to length 1 (0 without a known term).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import tok_whitespace

FEATURES = 1 << 14  # terms of the model; 4 MB of vectors at 64 dimensions
EXTRA = 16  # columns beyond those asked for
ROWS = 256  # texts multiplied at a time


@dataclass
class Model:
    terms: dict[str, int]
    idf: np.ndarray  # by term
    vectors: np.ndarray  # terms x dimensions
    singular: np.ndarray


def tokens(text: str | None) -> list[str]:
    """Lower-cased words; must be what ``vocabulary`` counts."""
    return (text or "").lower().split()


def vocabulary(texts: DataFrame, text_col: str, features: int = FEATURES) -> tuple[dict[str, int], np.ndarray]:
    """The ``features`` terms in the most texts (ties: smaller term) and their idf, ln(n / df) + 1."""
    words = F.array_distinct(F.transform(tok_whitespace(F.coalesce(F.col(text_col), F.lit(""))), F.lower))
    df = texts.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    top = df.orderBy(F.desc("df"), "term").limit(features).collect()
    n = texts.count()
    return {r["term"]: i for i, r in enumerate(top)}, np.array([np.log(n / r["df"]) + 1.0 for r in top])


def matrix(texts: list[str | None], terms: dict[str, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns, dense rows over those columns) of a few texts. Terms are counted in arrays, by sorting
    (row, term) numbers."""
    words = [tokens(t) for t in texts]
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, words), np.int64, len(words)))
    term = np.fromiter(map(terms.get, chain.from_iterable(words), repeat(-1)), np.int64, len(row))
    known, width = term >= 0, max(len(terms), 1)
    cell, tf = np.unique(row[known] * width + term[known], return_counts=True)
    row, term = np.divmod(cell, width)
    value = (1.0 + np.log(tf)) * idf[term]
    norms = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
    held = np.zeros(width, bool)
    held[term] = True
    columns = np.flatnonzero(held)
    rows = np.zeros((len(texts), len(columns)))
    rows[row, (np.cumsum(held) - 1)[term]] = value / np.where(norms > 0, norms, 1.0)[row]
    return columns, rows


def _product(texts: DataFrame, text_col: str, terms: dict[str, int], idf: np.ndarray, block: np.ndarray) -> np.ndarray:
    """A'A times ``block``, in one pass: a task gives out one line per term that its texts hold."""
    shared = texts.sparkSession.sparkContext.broadcast((terms, idf, block))
    width = block.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_, idf_, block_ = shared.value
        total, seen = np.zeros_like(block_), np.zeros(len(block_), bool)
        for batch in batches:
            held = batch.column(0).to_pylist()
            for at in range(0, len(held), ROWS):
                columns, rows = matrix(held[at : at + ROWS], terms_, idf_)
                if len(columns):
                    total[columns] += rows.T @ (rows @ block_[columns])
                    seen[columns] = True
        index = np.flatnonzero(seen)
        for at in range(0, len(index), 1024):
            part = index[at : at + 1024]
            yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array(np.ascontiguousarray(c)) for c in total[part].T]], names)

    names = ["i", *[f"c{j}" for j in range(width)]]
    lines = texts.select(text_col).mapInArrow(run, "i long, " + ", ".join(f"c{j} double" for j in range(width)))
    out = np.zeros_like(block)
    for batch in lines.groupBy("i").agg(*[F.sum(c).alias(c) for c in names[1:]]).toArrow().to_batches(4096):
        out[batch["i"].to_numpy()] = np.stack([batch[c].to_numpy() for c in names[1:]], axis=1)
    shared.unpersist()
    return out


def fit(texts: DataFrame, text_col: str, dim: int = 64, features: int = FEATURES, passes: int = 4, seed: int = 0) -> Model:
    """The ``dim`` strongest directions. Null texts are rows without terms. With fewer terms or texts than
    ``dim``, the rest of the singular values are 0."""
    terms, idf = vocabulary(texts, text_col, features)
    rng = np.random.default_rng(seed)
    block = rng.normal(size=(max(len(terms), 1), dim + EXTRA))
    if not terms:
        return Model({}, np.zeros(0), np.zeros((0, dim)), np.zeros(dim))
    for _ in range(passes):
        block, _ = np.linalg.qr(_product(texts, text_col, terms, idf, block))
    small = block.T @ _product(texts, text_col, terms, idf, block)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    best = np.argsort(-values)[:dim]
    vectors, singular = np.zeros((len(terms), dim)), np.zeros(dim)
    vectors[:, : len(best)] = block @ turn[:, best]
    singular[: len(best)] = np.sqrt(np.maximum(values[best], 0.0))
    vectors[:, singular <= 1e-9 * max(singular.max(), 1e-300)] = 0.0
    return Model(terms, idf, vectors, singular)


class Encoder:
    """The model as a batch encoder for ``vector.embed``: a list of texts to a matrix. It travels as a
    broadcast, which a worker loads once, whatever tasks it runs."""

    def __init__(self, spark: SparkSession, model: Model):
        self.shared = spark.sparkContext.broadcast((model.terms, model.idf, model.vectors.astype(np.float32)))
        self.dim = model.vectors.shape[1]

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        terms, idf, vectors = self.shared.value
        out = np.zeros((len(texts), self.dim))
        for at in range(0, len(texts), ROWS):
            columns, rows = matrix(texts[at : at + ROWS], terms, idf)
            out[at : at + ROWS] = rows @ vectors[columns]
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return out / np.where(norms > 0, norms, 1.0)
