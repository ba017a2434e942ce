"""Line dedup by pairwise alignment of documents that share lines."""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


@dataclass(frozen=True)
class Params:
    """rare: a line in at most so many documents pairs each of them with every earlier one; a line
    in more documents pairs each with the line's earliest holder only, so that the number of pairs
    grows with the number of lines while every line still meets an earlier copy of itself. Whatever
    the lines' counts, each run of lines (see ``runs``) pairs its documents with the run's earliest
    holder, so that every line of a common block meets an earlier copy of a run around it.
    min_words: an aligned block of consecutive lines is deleted if it has so many words."""

    rare: int = 8
    min_words: int = 20


def split_lines(text: str) -> list[tuple[int, bytes, int]]:
    """(line number, 128-bit hash of the trimmed line, words) of the lines that aren't blank."""
    import xxhash

    out = []
    for n, line in enumerate(text.split("\n")):
        words = line.split()
        if words:
            out.append((n, xxhash.xxh3_128_digest(line.strip().encode("utf-8", "surrogatepass")), len(words)))
    return out


def line_table(texts: pa.Array) -> pa.Array:
    at, line, pos, h, words = [0], [], [], [], []
    for t in texts:
        found = split_lines(t.as_py() or "")
        line += [x[0] for x in found]
        pos += range(len(found))
        h += [x[1] for x in found]
        words += [x[2] for x in found]
        at.append(len(line))
    rows = pa.StructArray.from_arrays(
        [pa.array(line, pa.int32()), pa.array(pos, pa.int32()), pa.array(h, pa.binary()), pa.array(words, pa.int32())],
        ["line", "pos", "h", "words"],
    )
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Index pairs of a patience diff: equal heads and tails, then the longest increasing run of the
    items that are single on both sides, and the same between its neighbours. A stretch without
    single common items is anchored at its rarest common item instead."""
    out, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = {}, {}
        for i in range(a0, a1):
            in_a.setdefault(a[i], []).append(i)
        for j in range(b0, b1):
            in_b.setdefault(b[j], []).append(j)
        common = [x for x in in_a if x in in_b]
        if not common:
            continue
        single = [(in_a[x][0], in_b[x][0]) for x in common if len(in_a[x]) == len(in_b[x]) == 1]
        if single:
            chain = _increasing(single)
        else:
            x = min(common, key=lambda x: (len(in_a[x]) * len(in_b[x]), in_a[x][0]))
            chain = [(in_a[x][0], in_b[x][0])]
        ends = [*chain, (a1, b1)]
        todo.append((a0, chain[0][0], b0, chain[0][1]))
        todo += [(i, i2, j, j2) for (i, j), (i2, j2) in zip(chain, ends[1:], strict=True)]  # a head starts at its anchor
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest chain of pairs rising on both sides; ``pairs`` rise on the first."""
    tops, last, back = [], [], []
    for n, (_, j) in enumerate(pairs):
        at = bisect_left(tops, j)
        if at == len(tops):
            tops.append(j)
            last.append(n)
        else:
            tops[at], last[at] = j, n
        back.append(last[at - 1] if at else -1)
    n, out = last[-1], []
    while n >= 0:
        out.append(pairs[n])
        n = back[n]
    return out[::-1]


def run_spans(seq: list[dict], min_words: int) -> list[tuple[bytes, int, int]]:
    """The shortest runs of consecutive lines with ``min_words`` words, from each line onwards and from each
    line backwards: hash, start and end in ``seq``. Every line of a block of so many words is in such a run
    within the block: where the lines up to it have too few words, the run from the block's start reaches
    past it."""
    import xxhash

    spans, i, total = set(), 0, 0
    at, h = 0, [bytes(x["h"]) for x in seq]  # the stretch of consecutive lines begins at ``at``
    for j, x in enumerate(seq):
        if j and x["pos"] != seq[j - 1]["pos"] + 1:
            at, i, total = j, j, 0
        total += x["words"]
        while total >= min_words:  # the lines from i to j - 1 had too few words
            spans.add((i, j + 1))
            total -= seq[i]["words"]
            i += 1
        if i > at:
            spans.add((i - 1, j + 1))
    return [(xxhash.xxh3_128_digest(b"".join(h[a:b])), a, b) for a, b in sorted(spans)]


def runs(seq: list[dict], min_words: int) -> list[bytes]:
    """Hashes of the runs of ``run_spans``."""
    return sorted({h for h, _, _ in run_spans(seq, min_words)})


def blocks_to_delete(later: list[dict], earlier: list[dict], min_words: int) -> list[int]:
    """Line numbers of ``later`` in aligned blocks of consecutive lines with at least ``min_words``.

    The patience diff keeps one order. So each run that both documents hold, and that the diff left a line
    of, is aligned once more as an anchor of its own, with the equal lines around it: blocks that stand in
    another order in ``earlier`` go too."""
    a, b = [bytes(x["h"]) for x in later], [bytes(x["h"]) for x in earlier]
    out = set(_blocks(patience(a, b), later, earlier, min_words))
    held = {h: j for h, j, _ in run_spans(earlier, min_words)}
    for h, i, end in run_spans(later, min_words):
        if h in held and any(later[x]["line"] not in out for x in range(i, end)):
            j = held[h]
            stop = j + end - i
            while i and j and a[i - 1] == b[j - 1]:
                i, j = i - 1, j - 1
            while end < len(a) and stop < len(b) and a[end] == b[stop]:
                end, stop = end + 1, stop + 1
            out |= set(_blocks([(i + x, j + x) for x in range(end - i)], later, earlier, min_words))
    return sorted(out)


def _blocks(pairs: list[tuple[int, int]], later: list[dict], earlier: list[dict], min_words: int) -> list[int]:
    out, run, words, prev = [], [], 0, None
    for i, j in [*pairs, (None, None)]:
        here = None if i is None else (later[i]["pos"], earlier[j]["pos"])
        if prev is None or here is None or here != (prev[0] + 1, prev[1] + 1):
            if words >= min_words:
                out += run
            run, words = [], 0
        if here:
            run.append(later[i]["line"])
            words += later[i]["words"]
        prev = here
    return out


def deletions(docs: DataFrame, id_col: str, text_col: str, p: Params = Params()) -> DataFrame:
    """(doc_id, tie, lines): the line numbers to delete from each document that loses some.

    A document is an id and a text (tie: its 64-bit hash), repeated rows being one document; ids
    decide which is later, and texts of one id are ordered by their hashes. Null ids and texts take
    no part. Only lines that at least two documents hold are carried beyond the first count.
    """
    table = F.arrow_udf(line_table, "array<struct<line: int, pos: int, h: binary, words: int>>")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie"), table(F.col(text_col).cast("string")).alias("l"))
    rows = rows.where(F.col("doc_id").isNotNull())
    lines = rows.select("doc_id", "tie", F.explode("l").alias("l")).select("doc_id", "tie", "l.*")
    lines = written(lines.dropDuplicates(["doc_id", "tie", "line"]), "lines")
    doc = F.struct("doc_id", "tie")
    # written, so that the join reads plain shuffles on both sides, of which AQE splits a hot line's
    holders = written(
        lines.groupBy("h", "doc_id", "tie").agg(F.lit(1).alias("one"))
        .groupBy("h").agg(F.count("one").alias("df"), F.min(doc).alias("first")).where("df > 1"),
        "line-holders",
    )
    shared = written(lines.join(holders, "h"), "shared-lines")
    held = shared.select("h", "df", "first", doc.alias("doc")).distinct()
    rare = held.where(F.col("df") <= p.rare).select("h", "doc")
    both = rare.join(rare.select("h", F.col("doc").alias("other")), "h").where(F.col("doc") > F.col("other"))
    star = held.where((F.col("df") > p.rare) & (F.col("doc") > F.col("first"))).select("doc", F.col("first").alias("other"))
    sequence = shared.groupBy(doc.alias("doc")).agg(F.sort_array(F.collect_list(F.struct("pos", "line", "h", "words"))).alias("seq"))

    @F.pandas_udf("array<binary>")
    def keys(seq: pd.Series) -> pd.Series:
        return pd.Series([runs(list(x), p.min_words) for x in seq], dtype=object)

    blocks = written(sequence.select("doc", F.explode(keys("seq")).alias("run")), "line-runs")
    first = blocks.groupBy("run").agg(F.count(F.lit(1)).alias("df"), F.min("doc").alias("other")).where("df > 1")
    first = written(first.select("run", "other"), "run-holders")
    block = blocks.join(first, "run").where(F.col("doc") > F.col("other")).select("doc", "other")
    pairs = both.select("doc", "other").union(star).union(block).distinct()
    aligned = pairs.join(sequence, "doc").join(sequence.select(F.col("doc").alias("other"), F.col("seq").alias("earlier")), "other")

    @F.pandas_udf("array<int>")
    def cut(later: pd.Series, earlier: pd.Series) -> pd.Series:
        return pd.Series([blocks_to_delete(list(a), list(b), p.min_words) for a, b in zip(later, earlier, strict=True)])

    gone = aligned.select("doc", F.explode(cut("seq", "earlier")).alias("line")).groupBy("doc", "line").agg(F.lit(1).alias("one"))
    return gone.groupBy("doc").agg(F.sort_array(F.collect_list("line")).alias("lines")).select("doc.doc_id", "doc.tie", "lines")


def dedup_lines(docs: DataFrame, id_col: str, text_col: str, p: Params = Params()) -> DataFrame:
    """``docs`` with the aligned common blocks deleted from the later documents, and a last column
    removed_lines (array of line numbers from 0, empty: unchanged; it replaces one of that name).

    Every row stays, in a document that loses all lines with an empty text; null ids and null or
    empty texts stay as they are, and repeated rows change alike.
    """
    gone = deletions(docs, id_col, text_col, p).select(F.struct("doc_id", "tie").alias("key"), "lines")
    rows = docs.select(F.struct("*").alias("in"))  # whatever the columns are called, none can clash
    text = F.col("in")[text_col]
    rows = rows.withColumn("key", F.struct(F.col("in")[id_col].alias("doc_id"), F.xxhash64(text).alias("tie")))
    out = rows.join(gone, "key", "left")
    left = F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("lines", i))
    cleaned = F.when(F.col("lines").isNull(), text).otherwise(F.array_join(left, "\n"))
    columns = [cleaned.alias(c) if c == text_col else F.col("in")[c].alias(c) for c in docs.columns if c != "removed_lines"]
    return out.select(*columns, F.coalesce("lines", F.array().cast("array<int>")).alias("removed_lines"))
