"""Audit of how filters interact: what each would remove at each step of every order of them.

A document's outcome under all orders depends only on the mask of filters that it fails. Each mask,
with its two labels, is mapped to one wide integer of ``WIDTH``-bit counters, one for every outcome of
every step of every order. The integers of a part's documents are summed, first inside the tasks and
then per part, and the sums are unpacked. A counter never exceeds the part's documents, which are
counted beside the sums, so that none runs over into the next.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written

WIDTH = 48  # bits of a counter
SPREAD = 64  # tasks that a part's partial sums are added up in at first
OUTCOMES = ("removed", "redundant", "good_lost", "toxic_lost")
SUMS = "part string, n long, total binary"


class Layout:
    """Where the counters lie. Fields: for each outcome of ``OUTCOMES``, one per (order, step); then one
    per filter for documents that fail it alone."""

    def __init__(self, filters: str):
        self.filters = filters
        self.orders = ["".join(p) for p in permutations(filters)]
        self.steps = [(o, s, f) for o in self.orders for s, f in enumerate(o)]
        self.fields = len(OUTCOMES) * len(self.steps) + len(filters)

    def wide(self, code: int) -> int:
        """The integer of a document: ``code`` holds its mask (bit f: fails filter f), then good and toxic."""
        k = len(self.filters)
        good, toxic = code >> k & 1, code >> k + 1 & 1
        values = {name: [0] * len(self.steps) for name in OUTCOMES}
        for at, (order, step, name) in enumerate(self.steps):
            if not code >> self.filters.index(name) & 1:
                continue
            if any(code >> self.filters.index(earlier) & 1 for earlier in order[:step]):
                values["redundant"][at] = 1
            else:
                values["removed"][at], values["good_lost"][at], values["toxic_lost"][at] = 1, good, toxic
        mask = code & ((1 << k) - 1)
        flat = [v for name in OUTCOMES for v in values[name]] + [int(mask == 1 << f) for f in range(k)]
        return sum(v << WIDTH * i for i, v in enumerate(flat))

    def counters(self, total: int) -> np.ndarray:
        raw = np.frombuffer(total.to_bytes(self.fields * WIDTH // 8, "little"), np.uint8).reshape(self.fields, WIDTH // 8)
        return raw.astype(np.int64) @ (1 << 8 * np.arange(WIDTH // 8, dtype=np.int64))


@lru_cache(4)
def table(filters: str) -> tuple[Layout, list[int]]:
    """The layout and the integers of all codes; one per worker."""
    layout = Layout(filters)
    return layout, [layout.wide(c) for c in range(1 << len(filters) + 2)]


def sums(parts: list, counts: list, totals: list) -> pa.RecordBatch:
    blobs = [t.to_bytes((t.bit_length() + 7) // 8, "little") for t in totals]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array(counts, pa.int64()), pa.array(blobs, pa.binary())], ["part", "n", "total"])


def mapped(rows: DataFrame, filters: str, held: int = 1024) -> DataFrame:
    """Partial sums (part, n, total) of rows (part, code): at most ``held`` parts are open in a task; when
    more are, all are given out and begun anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, wide = table(filters)
        open_: dict[str, list[int]] = {}
        for batch in batches:
            parts = batch["part"].dictionary_encode()
            keys = parts.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(wide) + batch["code"].to_numpy(zero_copy_only=False)
            names = parts.dictionary.to_pylist()
            for key, n in zip(*(x.tolist() for x in np.unique(keys, return_counts=True)), strict=True):
                held_ = open_.setdefault(names[key // len(wide)], [0, 0])
                held_[0] += n
                held_[1] += n * wide[key % len(wide)]
                if len(open_) > held:
                    yield sums(list(open_), *zip(*open_.values(), strict=True))
                    open_ = {}
        if open_:
            yield sums(list(open_), *zip(*open_.values(), strict=True))

    return rows.select("part", F.col("code").cast("int").alias("code")).mapInArrow(run, SUMS)


def added(partial: DataFrame) -> DataFrame:
    """Sums of partial sums that lie side by side by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = None, 0, 0
        for batch in batches:
            for p, k, t in zip(batch["part"].to_pylist(), batch["n"].to_pylist(), batch["total"].to_pylist(), strict=True):
                if p != part:
                    if part is not None:
                        yield sums([part], [n], [total])
                    part, n, total = p, 0, 0
                n += k
                total += int.from_bytes(t, "little")
        if part is not None:
            yield sums([part], [n], [total])

    return partial.mapInArrow(run, SUMS)


def outcomes(totals: DataFrame, filters: str) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout, _ = table(filters)
        steps, k = len(layout.steps), len(filters)
        letter = np.array([filters.index(f) for _, _, f in layout.steps])
        orders, number = pa.array([o for o, _, _ in layout.steps]), pa.array([s + 1 for _, s, _ in layout.steps], pa.int32())
        for batch in batches:
            for part, n, total in zip(*(batch[c].to_pylist() for c in ("part", "n", "total")), strict=True):
                if n >> WIDTH:
                    raise OverflowError(f"part {part!r} has {n} documents, more than a counter of {WIDTH} bits holds")
                flat = layout.counters(int.from_bytes(total, "little"))
                of = dict(zip(OUTCOMES, flat[: steps * len(OUTCOMES)].reshape(-1, steps), strict=True))
                alone = flat[steps * len(OUTCOMES) :]
                kept = n - np.cumsum(of["removed"].reshape(-1, k), axis=1).ravel()
                shapley = np.zeros(k, np.int64)
                np.add.at(shapley, letter, of["removed"])
                columns = [kept, of["removed"], of["redundant"], alone[letter], of["good_lost"], of["toxic_lost"], shapley[letter]]
                arrays = [pa.array([part] * steps, pa.string()), orders, number, *[pa.array(c) for c in columns]]
                yield pa.RecordBatch.from_arrays(arrays, NAMES)

    return totals.mapInArrow(run, RESULT)


RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)
NAMES = [c.split()[0] for c in RESULT.split(", ")]


def interactions(rows: DataFrame, filters: str) -> DataFrame:
    """The audit of a table (part string, code int), ``code`` as in ``Layout.wide``; an empty table gives
    no rows. A part's partial sums meet in ``SPREAD`` tasks at most before they meet in one, and are
    added one by one, so that a part with a third of all rows, or of all tasks' sums, overloads none."""
    partial = mapped(rows, filters).withColumn("_salt", F.spark_partition_id() % SPREAD)
    near = added(partial.repartition("part", "_salt").sortWithinPartitions("part", "_salt").select("part", "n", "total"))
    whole = added(near.repartition("part").sortWithinPartitions("part"))
    return outcomes(whole, filters)


def failures(text: Column) -> dict[str, Column]:
    """Conditions that a text fails by itself, by letter (words: runs of other characters than space and
    U+0009 to U+000D; null counts as empty)."""
    words = F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    counts = F.transform(F.array(words), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))[0]
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "words": counts,
        "C": 100 * capitals.cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Five filters over ``docs``, one row per part, order and step (see ``outcomes``).

    A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals (A to Z) > 5 * code points;
    D: one of # $ % & * |; E: a smaller id has an equal text. A null part is the empty string; a null text
    is empty; a row with a null id fails no E and makes no other row fail it; rows with one id are
    documents of their own. ``labels`` (id, quality, toxic): a document is good (toxic) if any of its
    label rows has 1 there; ids without labels are neither. Other columns are ignored.

    Texts are read once, in the row; only their digests move. A row is the first of its text if it meets
    the text's smallest id, a join by digest and id, so that copies of one text spread over the tasks.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    bad = failures(text)
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.sha2(text.cast("binary"), 256).alias("_sha"),
        bad["words"].alias("_w"),
        (bad["C"].cast("int") * 4 + bad["D"].cast("int") * 8).alias("_cd"),
    )
    own = (F.col("_w.n") < 50).cast("int") + 2 * (100 * F.col("_w.d").cast("long") < 65 * F.col("_w.n").cast("long")).cast("int")
    rows = written(rows.select("_id", "part", F.unhex("_sha").alias("_sha"), (own + F.col("_cd")).alias("_own")), "audit")
    first = rows.groupBy("_sha").agg(F.min("_id").alias("_id")).where("_id IS NOT NULL").withColumn("_first", F.lit(1))
    marks = labels.groupBy(F.col(id_col).alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic")
    )
    marked = rows.join(first, ["_sha", "_id"], "left").join(marks, "_id", "left")
    later = (F.col("_id").isNotNull() & F.col("_first").isNull()).cast("int")
    code = F.col("_own") + 16 * later + 32 * F.coalesce("_good", F.lit(0)) + 64 * F.coalesce("_toxic", F.lit(0))
    return interactions(marked.select("part", code.alias("code")), "ABCDE")
