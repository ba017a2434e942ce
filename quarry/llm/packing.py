"""Packing documents into fixed-length sequences: shortest-pack-first over the length histogram."""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import numbered, ordinals

#: Fixed value: the pattern by which GPT-2's byte-level BPE splits a text. Its end, which leaves a
#: run of white space without its last character, matters to texts with such a run only; the others
#: are split without look-ahead, which is faster.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
#: The white space characters (Unicode White_Space and Python's separators) besides
#: space and line feed, and the runs of those two.
OTHER_WHITE = "\t\v\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
RUNS = ("  ", "\n\n", " \n", "\n ")
PIECE = "start long, length long, ids binary, doc_tokens long"


class Encoder:
    """Ids of a byte-level BPE vocabulary file.

    A text without the file's special-token strings is encoded by tiktoken from the file's ranks,
    which gives the ids of tokenizers several times faster (a test compares them), any other text by
    tokenizers itself.
    """

    def __init__(self, path: str):
        import tiktoken

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        back = {chr(b): b for b in printable}
        back |= {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        ranks = {bytes(back[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in self.specials}
        self.ranks = ranks
        self.fast = tiktoken.Encoding("fast", pat_str=WORDS + r"|\s+", mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def exact(self):
        import tiktoken

        return tiktoken.Encoding("exact", pat_str=WORDS + r"|\s+(?!\S)|\s+", mergeable_ranks=self.ranks, special_tokens={})

    @cached_property
    def full(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def __call__(self, text: str) -> list[int]:
        if any(s in text for s in self.specials):
            return self.full.encode(text, add_special_tokens=False).ids
        runs = any(r in text for r in RUNS) or any(c in text for c in OTHER_WHITE)  # far faster than a pattern
        return (self.exact if runs else self.fast).encode_ordinary(text)


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per worker, whatever tasks it runs."""
    return Encoder(path)


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, cap: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens.

    A document is its text's ids (null text: none) and then ``end_id``, so every row has at least
    one id; it is cut into full sequences and a rest. Repeated rows and null ids are documents of
    their own.
    """

    @F.arrow_udf(f"array<struct<{', '.join(c.replace(' ', ': ', 1) for c in PIECE.split(', '))}>>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        enc = encoder(vocabulary)
        for texts in batches:
            at, starts, lengths, blobs, totals = [0], [], [], [], []
            for t in texts:
                ids = enc(t.as_py() or "")
                ids.append(end_id)
                blob = array("I", ids).tobytes()
                for s in range(0, len(ids), cap):
                    starts.append(s)
                    lengths.append(min(cap, len(ids) - s))
                    blobs.append(blob[4 * s : 4 * (s + cap)])
                    totals.append(len(ids))
                at.append(len(starts))
            rows = pa.StructArray.from_arrays(
                [pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(blobs, pa.binary()), pa.array(totals, pa.int64())],
                [c.split()[0] for c in PIECE.split(", ")],
            )
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)

    rows = docs.select(F.col(id_col).alias("doc_id"), encode(F.col(text_col).cast("string")).alias("p"))
    return rows.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.*")


@dataclass
class Pattern:
    count: int  # sequences packed this way
    lengths: list[int]


def plan(histogram: dict[int, int], cap: int) -> list[Pattern]:
    """Shortest-pack-first: lengths from the longest to the shortest, each to the packs with the most
    room that take it, in bulk: only counts of packing patterns change.

    Every step uses up a group of packs or a length, so there are at most 2 x cap patterns whatever
    the counts are.
    """
    room: list[list[Pattern]] = [[] for _ in range(cap + 1)]
    for length in sorted(histogram, reverse=True):
        left, r = histogram[length], cap
        while left:
            while r >= length and not room[r]:
                r -= 1
            if r < length:
                room[cap - length].append(Pattern(left, [length]))
                break
            pack = room[r].pop()
            used = min(left, pack.count)
            if used < pack.count:
                room[r].append(Pattern(pack.count - used, pack.lengths))
            room[r - length].append(Pattern(used, [*pack.lengths, length]))
            left -= used
    return [p for group in room for p in group]


def slots(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: (first rank, sequence of that rank, offset in it) of the slots, by rank."""
    out: dict[int, list[tuple[int, int, int]]] = {}
    ranks: dict[int, int] = {}
    first = 0
    for p in patterns:
        offset = 0
        for length in p.lengths:
            r = ranks.get(length, 0)
            out.setdefault(length, []).append((r, first, offset))
            ranks[length] = r + p.count
            offset += length
        first += p.count
    return {k: tuple(np.array(v, np.int64).T) for k, v in out.items()}


def assign(rows: DataFrame, cap: int) -> DataFrame:
    """``rows`` (a numbered table with a column length) plus sequence_id and offset.

    The histogram has at most ``cap`` lines and the plan at most 2 x cap patterns; both fit on the
    driver whatever the corpus is. A piece's rank among those of its length comes from
    ``ordinals`` and its slot from a search in the length's slots.
    """
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = rows.sparkSession.sparkContext.broadcast(slots(plan(counts, cap)))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def find(length: pa.Array, rank: pa.Array) -> pa.Array:
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        seq, off = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        for k in np.unique(n):
            at = np.flatnonzero(n == k)
            first, sequence, offset = table.value[int(k)]
            s = np.searchsorted(first, r[at], side="right") - 1
            seq[at] = sequence[s] + r[at] - first[s]
            off[at] = offset[s]
        return pa.StructArray.from_arrays([pa.array(seq), pa.array(off)], ["sequence_id", "offset"])

    ranked = ordinals(rows, "length", "_rank")
    return ranked.withColumn("_slot", find("length", "_rank")).select("*", "_slot.*").drop("_slot", "_rank")


def pack(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, cap: int = 2048, end_id: int = 1) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Sequences are numbered from 0; in each, the pieces lie side by side from offset 0, the longest
    first. An empty table gives no rows.
    """
    rows = numbered(pieces(docs, id_col, text_col, vocabulary, cap, end_id), "pieces")
    keys = assign(rows.select("_row", "length"), cap).drop("length")
    return rows.join(keys, "_row").drop("_row")
