"""Benchmark decontamination by q-gram lemma filtering and banded alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MULT = np.uint64(0x9E3779B97F4A7C15)
BASE = np.uint64(0x100000001B3)
HITS = "item_id string, start long, end long, edits long"


@dataclass(frozen=True)
class Params:
    """q: characters of a gram. An item of m characters is found with up to rate * m edits, as far
    as the lemma still asks for one shared gram: k = min(rate * m, (m - q) / q).
    block_chars: items are indexed in blocks of at most so many characters (at least one item),
    which bounds what a task holds of the benchmark; documents are scanned once per block."""

    q: int = 10
    rate: float = 0.08
    block_chars: int = 2_000_000


def normal(text: str | None) -> str:
    """Lower case, runs of white space as one space, trimmed."""
    return " ".join((text or "").lower().split())


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(p: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at every position, by doubling."""
    if len(p) < q:
        return np.zeros(0, np.uint64)
    h, have = p.astype(np.uint64), 1
    single = h
    while have * 2 <= q:
        h = h[: len(h) - have] * np.uint64(pow(int(BASE), have, 1 << 64)) + h[have:]
        have *= 2
    while have < q:
        h = h[: len(p) - have] * BASE + single[have : have + len(p) - have]
        have += 1
    return h * MULT


class Index:
    """The grams of a block of items."""

    FILTER_BITS = 22

    def __init__(self, items: list[tuple[str, str]], p: Params):
        self.q = p.q
        self.ids = [i for i, _ in items]
        self.texts = [t for _, t in items]
        self.points = [points(t) for _, t in items]
        self.short = [(n, t) for n, (_, t) in enumerate(items) if 0 < len(t) < p.q]
        m = np.array([len(x) for x in self.points], np.int64)
        self.m = m
        self.k = np.maximum(0, np.minimum((m * p.rate).astype(np.int64), (m - p.q) // p.q))
        self.least = m - p.q + 1 - self.k * p.q  # shared grams of a match, by the lemma
        parts = [grams(x, p.q) for x in self.points]
        h = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(parts)), [len(x) for x in parts])
        place = np.concatenate([np.arange(len(x)) for x in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(h, kind="stable")
        self.h, self.owner, self.place = h[order], owner[order], place[order]
        self.filter = np.zeros(1 << self.FILTER_BITS, bool)
        self.filter[(h >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)] = True

    def candidates(self, p: np.ndarray, piece: int = 1 << 14) -> list[tuple[int, int]]:
        """(item, band) with enough shared grams. Band b of an item with k edits holds the diagonals
        b (k + 1) to (b + 2) (k + 1); neighbours overlap by half, so the k + 1 diagonals of any
        match lie in one band."""
        keys = []
        for at in range(0, max(0, len(p) - self.q + 1), piece):
            g = grams(p[at : at + piece + self.q - 1], self.q)
            hit = np.flatnonzero(self.filter[(g >> np.uint64(64 - self.FILTER_BITS)).astype(np.int64)])
            g = g[hit]
            lo, hi = np.searchsorted(self.h, g, "left"), np.searchsorted(self.h, g, "right")
            n = hi - lo
            if not n.any():
                continue
            row = np.repeat(np.arange(len(g)), n)
            entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            item = self.owner[entry]
            diagonal = at + hit[row] - self.place[entry]
            band = diagonal // (self.k[item] + 1)
            both = np.concatenate([(item << 40) + band + (1 << 39), (item << 40) + band - 1 + (1 << 39)])
            u, c = np.unique(both, return_counts=True)
            keys.append(np.stack([u, c]))
        if not keys:
            return []
        allk = np.concatenate(keys, axis=1)
        u, inv = np.unique(allk[0], return_inverse=True)
        c = np.bincount(inv, allk[1])
        item = u >> 40
        ok = c >= self.least[item]
        return [(int(i), int(b)) for i, b in zip(item[ok], (u[ok] & ((1 << 40) - 1)) - (1 << 39), strict=True)]

    def search(self, text: str) -> list[tuple[str, int, int, int]]:
        """(item id, start, end, edits) of the best match of every item found in a normal text."""
        p = points(text)
        best: dict[int, tuple[int, int, int]] = {}
        for item, first, last in _runs(self.candidates(p)):
            k, m = int(self.k[item]), int(self.m[item])
            if item in best and best[item][0] == 0:
                continue
            lo, hi = first * (k + 1), (last + 2) * (k + 1) - 1
            window = text[max(0, lo) : max(0, hi + 1 + m)]
            if (exact := window.find(self.texts[item])) >= 0:  # no edits: the alignment is the text itself
                best[item] = (0, max(0, lo) + exact, max(0, lo) + exact + m)
                continue
            found = align(self.points[item], p, lo, hi, k)
            if found and (item not in best or found < best[item]):
                best[item] = found
        for item, t in self.short:
            at = text.find(t)
            if at >= 0:
                best[item] = (0, at, at + len(t))
        return [(self.ids[i], s, e, d) for i, (d, s, e) in sorted(best.items())]


def _runs(found: list[tuple[int, int]]) -> Iterator[tuple[int, int, int]]:
    """(item, first, last) of the runs of up to four neighbouring bands, which one alignment takes."""
    run = None
    for item, band in found:
        if run and run[0] == item and band == run[2] + 1 and band - run[1] < 4:
            run = (item, run[1], band)
            continue
        if run:
            yield run
        run = (item, band, band)
    if run:
        yield run


def align(item: np.ndarray, text: np.ndarray, lo: int, hi: int, k: int) -> tuple[int, int, int] | None:
    """Best (edits, start, end) of the whole item within the text, with at most k edits, on paths
    that touch the diagonals lo..hi (text position minus item position), or None.

    The band is k wider on either side; cells hold the edits and the start of their path, packed
    into one integer so that the smaller wins.
    """
    m, n = len(item), len(text)
    lo, hi = lo - k, hi + k
    width = hi - lo + 1
    shift = n + 2
    far = np.int64((m + n + 5) * shift)
    diag = np.arange(lo, hi + 1)
    col = diag.astype(np.int64)  # text positions reached by row 0
    cur = np.where((col >= 0) & (col <= n), np.clip(col, 0, n), far)
    step = np.arange(width, dtype=np.int64) * shift
    padded = np.concatenate([text, np.zeros(1, np.uint32)])
    for i in range(1, m + 1):
        col = diag + i
        inside = (col >= 1) & (col <= n)
        same = padded[np.clip(col - 1, 0, n)] == item[i - 1]
        nxt = np.where(inside, cur + np.where(same, 0, shift), far)
        nxt[:-1] = np.minimum(nxt[:-1], cur[1:] + shift)  # an item character without partner
        nxt = np.where((col >= 0) & (col <= n), nxt, far)
        nxt = np.minimum.accumulate(nxt - step) + step  # text characters without partner
        cur = np.where((col >= 0) & (col <= n), nxt, far)
        if not i % 8 and cur.min() >= (k + 1) * shift:
            return None
    at = int(np.argmin(cur))
    edits, start = divmod(int(cur[at]), shift)
    return (edits, start, int(diag[at] + m)) if edits <= k else None


def blocks(benchmark: DataFrame, id_col: str, text_col: str, p: Params) -> Iterator[list[tuple[str, str]]]:
    """Normal items in blocks of bounded size, one at a time, ordered by id. Equal texts stay apart;
    null and empty texts match nothing."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("t IS NOT NULL")
    block, size = [], 0
    for r in rows.orderBy("i", "t").toLocalIterator():
        t = normal(r["t"])
        if not t:
            continue
        if block and size + len(t) > p.block_chars:
            yield block
            block, size = [], 0
        block.append((r["i"], t))
        size += len(t)
    if block:
        yield block


def find(docs: DataFrame, text_col: str, benchmark: DataFrame, item_id: str, item_text: str, p: Params = Params()) -> list[DataFrame]:
    """Per block of items: ``docs`` plus ``hits``, an array of structs (HITS) with the best match of
    each item in the row's whole text (null: none). Spans count characters of the normal text."""
    out = []
    for block in blocks(benchmark, item_id, item_text, p):
        shared = docs.sparkSession.sparkContext.broadcast((block, p))  # at most block_chars, or one item
        out.append(docs.withColumn("hits", _searcher(shared)(F.col(text_col).cast("string"))))
    return out


def _searcher(shared):
    @F.pandas_udf(f"array<struct<{', '.join(c.replace(' ', ': ', 1) for c in HITS.split(', '))}>>")
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(*shared.value)
        for texts in batches:
            found = [index.search(normal(t)) for t in texts]
            yield pd.Series([[dict(zip(("item_id", "start", "end", "edits"), h, strict=True)) for h in f] for f in found])

    return search


def contaminated(
    docs: DataFrame, doc_id: str, text_col: str, benchmark: DataFrame, item_id: str, item_text: str, p: Params = Params()
) -> DataFrame:
    """One row per document row and item found in it: doc_id, item_id, start, end, edits.

    Clean documents, empty tables and null texts give no rows; repeated rows give their own; a null
    doc_id stays null.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text_col).alias("text"))
    item_type = benchmark.schema[item_id].dataType.simpleString()
    parts = [
        found.select("doc_id", F.explode("hits").alias("h")).select("doc_id", F.col("h.item_id").cast(item_type).alias("item_id"), "h.start", "h.end", "h.edits")
        for found in find(rows, "text", benchmark, item_id, item_text, p)
    ]
    if not parts:
        return rows.where("false").select("doc_id", F.lit(None).cast(item_type).alias("item_id"), *[F.lit(0).cast("long").alias(c) for c in ("start", "end", "edits")])
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def clean(docs: DataFrame, text_col: str, benchmark: DataFrame, item_id: str, item_text: str, p: Params = Params()) -> DataFrame:
    """The rows of ``docs``, unchanged, in which no item is found. Blocks filter one after another."""
    out = docs
    for block in blocks(benchmark, item_id, item_text, p):
        shared = docs.sparkSession.sparkContext.broadcast((block, p))
        out = out.where(F.size(_searcher(shared)(F.col(text_col).cast("string"))) == 0)
    return out
