"""Periodic runs of words: stretches that repeat with a short period, found by multi-scale minimizers.

A run is a stretch of words with smallest period q and a length of at least max(6, 4 q) that no
neighbouring word extends. Periods up to ``SHORT`` are found by comparing the words with those q
places on. Longer ones are found scale by scale: for periods in [W, 2 W) the leftmost minimum of
every window of W grams (2 W words each) is selected. Two windows a period apart inside a run hold
the same grams, so their minima are a period apart, and grams of a run less than a period apart
differ; hence the next selected gram of the same hash is exactly one period on. Such a pair seeds an
extension word by word. No run is missed, and work and memory are about linear in the words
(times the number of scales), whatever the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORT = 15  # longest period that is scanned directly
FACTOR, LEAST = 4, 6  # a run has max(LEAST, FACTOR * period) words
GROUP = 200_000  # words scanned together; a longer text is a group of its own
RUNS = "array<struct<start: long, length: long, period: long>>"


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mix (the finaliser of splitmix64) of every entry."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _stretch(w: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The largest [s, e) around ``at`` with w[i] = w[i + lag] for all i in it."""
    e, step = at, 64
    while True:
        to = min(e + step, len(w) - lag)
        off = np.flatnonzero(w[e:to] != w[e + lag : to + lag])
        if len(off):
            e += int(off[0])
            break
        e = max(e, to)
        if e >= len(w) - lag:
            break
        step *= 2
    s, step = at, 64
    while s > 0:
        to = max(0, s - step)
        off = np.flatnonzero(w[to:s] != w[to + lag : s + lag])
        if len(off):
            s = to + int(off[-1]) + 1
            break
        s, step = to, 2 * step
    return s, e


def _primitive(word: np.ndarray) -> bool:
    """Whether ``word`` is no shorter word repeated."""
    n, rest, f = len(word), len(word), 2
    while rest > 1:
        if f * f > rest:
            f = rest
        if rest % f == 0:
            d = n // f
            if np.array_equal(word[d:], word[:-d]):
                return False
            while rest % f == 0:
                rest //= f
        f += 1
    return True


def _pairs(h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of selected grams and the distance to the next selected gram of the same hash, where
    that lies in [window, 2 * window); by position."""
    bits = np.uint64(max(1, int(len(h)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    m = (h & ~low) | np.arange(len(h), dtype=np.uint64)  # of equal hashes the leftmost is least
    span = 1
    while span < window:
        m = np.minimum(m[:-span], m[span:])
        span *= 2
    at = np.unique(m & low).astype(np.int64)
    order = np.argsort(h[at], kind="stable")
    p, v = at[order], h[at[order]]
    d = p[1:] - p[:-1]
    ok = (v[1:] == v[:-1]) & (d >= window) & (d < 2 * window)
    p, d = p[:-1][ok], d[ok]
    by = np.argsort(p, kind="stable")
    return p[by], d[by]


def find(w: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of ``w``: texts of ``lengths`` words side by side, longest first,
    each followed by one code of its own, so that no run crosses a border."""
    runs = []
    for q in range(1, SHORT + 1):
        n = int((lengths[lengths >= max(LEAST, FACTOR * q)] + 1).sum())
        if n <= q:
            break
        same = np.zeros(n - q + 2, np.int8)
        same[1:-1] = w[: n - q] == w[q:n]
        edge = np.diff(same)
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        for a, b in zip(s[ok := e - s + q >= max(LEAST, FACTOR * q)].tolist(), e[ok].tolist(), strict=True):
            if _primitive(w[a : a + q]):
                runs.append((a, b - a + q, q))
    gram, size, window = _mixed(w.astype(np.uint64) + np.uint64(1)), 1, 1
    while True:
        n = int((lengths[lengths >= FACTOR * window] + 1).sum())  # the texts that can hold such a run
        if n == 0:
            return runs
        gram = gram[:n]
        while size < 2 * window:
            gram = _mixed(gram[:-size] * np.uint64(0x9E3779B97F4A7C15) + _mixed(gram[size:]))
            size *= 2
        if window > SHORT and len(gram) >= window:
            done: dict[int, int] = {}
            for p, d in zip(*(x.tolist() for x in _pairs(gram, window)), strict=True):
                if p < done.get(d, -1):
                    continue
                s, e = _stretch(w, p, d)
                done[d] = e
                if e - s + d >= FACTOR * d and _primitive(w[s : s + d]):
                    runs.append((s, e - s + d, d))
        window *= 2


def _group(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """Runs and collapsed text of each text."""
    words = [t.split() for t in texts]
    lengths = np.array([len(x) for x in words])
    order = np.argsort(-lengths, kind="stable")
    flat = [x for i in order for x in words[i]]
    codes = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    sorted_lengths = lengths[order]
    ends = np.cumsum(sorted_lengths)
    starts = ends - sorted_lengths + np.arange(len(order))
    w = np.insert(codes, ends, len(flat) + np.arange(len(order)))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for s, length, q in find(w, sorted_lengths):
        k = int(np.searchsorted(starts, s, side="right")) - 1
        out[order[k]].append((s - int(starts[k]), length, q))
    collapsed = []
    for held, found in zip(words, out, strict=True):
        found.sort(key=lambda r: (r[0], r[2]))
        if found:
            keep = np.ones(len(held), bool)
            for s, length, q in found:
                keep[s + q : s + length] = False
            held = [x for x, k in zip(held, keep.tolist(), strict=True) if k]
        collapsed.append(b" ".join(held))
    return out, collapsed


def detect(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per row of ``docs``: doc_id, runs, collapsed.

    Words are maximal sequences of other characters than space and U+0009 to U+000D. ``runs`` holds
    every run as (start, length, period), by start and then period; ``collapsed`` the words joined by
    one space, without those that a run holds after its first period. A null, empty or blank text has
    no runs and an empty ``collapsed``; repeated rows and null ids are documents of their own; other
    columns are ignored. A text is scanned whole, in its row: no shuffle, no size limit but a row's.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, size = 0, 0
            texts = [(t or "").encode() for t in batch["text"].to_pylist()]
            for i, t in enumerate(texts):
                size += len(t)
                if size > 4 * GROUP or i == len(texts) - 1:
                    yield rows_of(batch["doc_id"][at : i + 1], *_group(texts[at : i + 1]))
                    at, size = i + 1, 0

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, runs {RUNS}, collapsed string")


def rows_of(ids: pa.Array, found: list[list[tuple[int, int, int]]], collapsed: list[bytes]) -> pa.RecordBatch:
    at = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
    columns = np.array([r for f in found for r in f], np.int64).reshape(-1, 3).T
    flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(pa.array(at), flat)
    return pa.RecordBatch.from_arrays([ids, runs, pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "runs", "collapsed"])
