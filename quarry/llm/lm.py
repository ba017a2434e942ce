"""LM scoring: corpus word counts, a gated recurrent model trained on every training text, and the
log probability of whole documents."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm import gru
from quarry.llm.common import held_out, numbered, utf8, written

END = b""  # the token after the last word of a text; no word is empty


@dataclass(frozen=True)
class Params:
    """The ``head`` most frequent words (of at most ``word_bytes`` bytes) have their own place in the
    network; the others fall into ``tails`` classes by a hash of their last two bytes. ``known``: as
    many frequent words go to every task with their counts, the rest is joined. lanes x steps tokens
    make one step of truncated backpropagation. ``warm_texts``: the sample of whole training texts
    (at most ``warm_bytes`` long each) from which all tasks start; after it every training text
    counts. ``group``: most models that one task averages. ``buffer``: tokens a task runs at once."""

    head: int = 1024
    tails: int = 64
    known: int = 65_536
    word_bytes: int = 64
    hidden: int = 16
    lanes: int = 512
    steps: int = 16
    rate: float = 0.01
    warm_texts: int = 400
    warm_bytes: int = 100_000
    group: int = 256
    buffer: int = 8_000_000
    smoothing: float = 0.1


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased words of all texts (binary), and where each text's begin and end among them."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    words, ends = lists.values.view(pa.binary()), lists.offsets.to_numpy()
    full = pc.not_equal(pc.binary_length(words), 0)  # white space at a text's ends leaves empty pieces
    if pc.min(full).as_py() is not False:
        return words, ends
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return words.filter(full), kept[ends]


def tail_of(word: bytes, p: Params) -> int:
    return zlib.crc32(word[-2:]) % p.tails


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c) over a binary column t, counted in each batch first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words, c = split_words(batch.column(0))[0].value_counts().flatten()
            for i in range(0, len(words), 100_000):
                yield pa.record_batch([words[i : i + 100_000], c[i : i + 100_000]], ["word", "c"])
            yield pa.record_batch([pa.array([END]), pa.array([batch.num_rows], pa.int64())], ["word", "c"])

    return texts.select("t").mapInArrow(count, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """What every task needs of the counts: totals, the frequent words and the tail classes."""

    def __init__(self, p: Params, n: int, v: int, frequent: list[tuple[bytes, int]], tail_n: np.ndarray, tail_v: np.ndarray):
        self.p, self.n, self.v, self.tail_n, self.tail_v = p, n, v, tail_n, tail_v
        head = [END, *[w for w, _ in frequent if w != END][: p.head - 1]]
        self.head = len(head)
        self.symbol = {w: i for i, w in enumerate(head)}
        self.counts = dict(frequent)
        self.counts.setdefault(END, 0)

    def frequency(self) -> np.ndarray:
        return np.concatenate([[self.counts[w] for w in self.symbol], self.tail_n]).astype(np.float64)

    def base(self, c):
        a = self.p.smoothing
        return np.log10((c + a) / (self.n + a * (self.v + 1)))

    def within_tail(self, c, tail):
        """Log10 of a word's share of its tail class; all words not seen in training are one word."""
        a = self.p.smoothing
        return np.log10((c + a) / (self.tail_n[tail] + a * (self.tail_v[tail] + 1)))


def vocabulary(counts: DataFrame, p: Params) -> Vocabulary:
    """From the table of counts: at most ``known`` words of at most ``word_bytes`` bytes come to the
    driver. They are those above the least frequency class (sixteenths of powers of two) down to
    which ``known`` words go, so tasks filter by a bound instead of sending their own best."""
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    level = F.floor(F.log2(F.col("c")) * 16).cast("int")
    short = counts.where(F.octet_length("word") <= p.word_bytes).withColumn("level", level)
    edge, total = 1 << 30, 0
    for r in sorted(short.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r["level"]):  # under 1100 levels
        total += r["n"]
        if total > p.known:
            break
        edge = r["level"]
    top = short.where(F.col("level") >= edge).collect()
    frequent = sorted(((bytes(r["word"]), r["c"]) for r in top), key=lambda x: (-x[1], x[0]))
    tail = (F.crc32(F.expr("substring(word, -2, 2)")) % p.tails).alias("tail")
    per = counts.groupBy(tail).agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()
    tail_n, tail_v = np.zeros(p.tails), np.zeros(p.tails)
    for r in per:
        tail_n[r["tail"]], tail_v[r["tail"]] = r["n"], r["v"]
    out = Vocabulary(p, n, v, frequent, tail_n, tail_v)
    for w in out.symbol:  # words of the head are in no tail
        if out.counts[w]:
            t = tail_of(w, p)
            tail_n[t] -= out.counts[w]
            tail_v[t] -= 1
    return out


class Lookup:
    """Symbols and counts of words, for whole batches of texts: the frequent words are found by a hash table
    made of them, the tail class of the others follows from their last bytes."""

    def __init__(self, vocab: Vocabulary):
        p = vocab.p
        words = list(vocab.counts)
        self.vocab, self.words = vocab, pa.array(words, pa.binary())
        self.symbols = np.array([vocab.symbol.get(w, vocab.head + tail_of(w, p)) for w in words], np.int32)
        self.c = np.array(list(vocab.counts.values()), np.int64)
        ends = [bytes([a]) for a in range(256)] + [bytes([a, b]) for a in range(256) for b in range(256)]
        self.tails = np.array([vocab.head + tail_of(w, p) for w in ends], np.int32)

    def places(self, words: pa.Array) -> np.ndarray:
        """Number of each word among the frequent ones, else -1."""
        return pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy()

    def encode(self, words: pa.Array, places: np.ndarray) -> np.ndarray:
        out = self.symbols[places]
        rare = np.flatnonzero(places < 0)
        if len(rare):
            _, offsets, data = words.buffers()
            at = np.frombuffer(offsets, np.int32)[words.offset :]
            data = np.frombuffer(data, np.uint8)
            end = at[rare + 1]
            last = data[end - 1].astype(np.int64)
            two = end - at[rare] > 1
            out[rare] = self.tails[np.where(two, 256 + 256 * data[end - 2].astype(np.int64) + last, last)]
        return out

    def documents(self, texts: pa.Array) -> tuple[pa.ListArray, np.ndarray, np.ndarray, pa.Array]:
        """Symbols of each text's tokens; the places of all texts' tokens; their words, and where each text's
        begin and end among them."""
        words, ends = split_words(texts)
        places = self.places(words)
        stops = ends[1:] + np.arange(len(texts))
        inner = np.ones(len(words) + len(texts), bool)
        inner[stops] = False
        symbols, at = np.zeros(len(inner), np.int32), np.full(len(inner), self.places(pa.array([END]))[0], np.int32)
        symbols[inner], at[inner] = self.encode(words, places), places
        offsets = np.concatenate([[0], stops + 1]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(symbols)), at, ends, words


def _buffered(batches: Iterator[pa.RecordBatch], p: Params, read: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of what ``read`` makes of the batches, its first column being the rows' symbols; each table
    has about ``buffer`` symbols (or one longer text). Long texts run beside many others then. Batches are
    read by pieces of ``piece`` rows, so that little is held of what only reading needs."""
    held, n, piece = [], 0, 1024
    for rows in (read(batch.slice(i, piece)) for batch in batches for i in range(0, batch.num_rows, piece)):
        ends = rows.column(0).offsets.to_numpy()
        at = 0
        while at < len(rows):
            to = min(int(np.searchsorted(ends[1:], ends[at] + p.buffer - n)) + 1, len(rows))
            held.append(rows.slice(at, to - at))
            n += int(ends[to] - ends[at])
            at = to
            if n >= p.buffer:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _arrays(column: pa.ChunkedArray) -> list[np.ndarray]:
    out = []
    for lists in column.chunks:
        values = lists.values.to_numpy()
        out += [values[a:b] for a, b in pairwise(lists.offsets.to_numpy().tolist())]
    return out


def train(texts: DataFrame, vocab: Vocabulary, p: Params) -> np.ndarray:
    """The network's parameters.

    A short warm-up on a bounded sample gives one start for all; then every task runs all of its
    training texts once from there, and the tasks' parameters are averaged with the numbers of
    tokens as weights, in blocks and in two levels, so no task adds up more than ``group`` models.
    """
    shape = gru.Shape(vocab.head, p.tails, p.hidden)
    model = gru.Gru.fresh(shape, vocab.frequency())
    short = texts.where(F.octet_length("t") <= p.warm_bytes)
    # the hash below which warm_texts rows lie; over row numbers, so that equal rows don't tie
    h = F.xxhash64("_row")
    short = short.withColumn("_row", F.monotonically_increasing_id()).select(h.alias("h"), "t")
    edge = short.select("h").orderBy("h").limit(p.warm_texts).agg(F.max("h")).first()[0]
    if edge is not None:  # else all tasks start from the fresh network
        texts_here = pa.array([bytes(r["t"]) for r in short.where(F.col("h") <= edge).orderBy("h").collect()], pa.binary())
        warm = _arrays(pa.chunked_array([Lookup(vocab).documents(texts_here)[0]]))
        gru.train(model, warm, 64, p.steps, 0, gru.Adam(shape.size(), p.rate))
    shared = texts.sparkSession.sparkContext.broadcast((vocab, shape, model.theta))
    block = 4096

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab, shape, theta = shared.value
        own, lookup = gru.Gru(shape, theta.copy()), Lookup(vocab)
        adam, n = gru.Adam(shape.size(), p.rate / 4), 0
        for rows in _buffered(batches, p, lambda batch: pa.record_batch([lookup.documents(batch.column(0))[0]], ["symbols"])):
            docs = _arrays(rows["symbols"])
            gru.train(own, docs, p.lanes, p.steps, 0, adam)
            n += sum(map(len, docs))
        if n:
            pid = TaskContext.get().partitionId()
            parts = [own.theta[i : i + block] * np.float32(n) for i in range(0, shape.size(), block)]
            yield pa.record_batch(
                [
                    pa.array(np.full(len(parts), pid // p.group)),
                    pa.array(np.arange(len(parts))),
                    pa.array(np.full(len(parts), float(n))),
                    pa.array(parts, pa.list_(pa.float32())),
                ],
                ["many", "block", "n", "sums"],
            )

    def add(table: pa.Table) -> pa.Table:
        sums = np.stack([x.values.to_numpy() for x in table["sums"]]).astype(np.float64).sum(axis=0)
        n = float(np.sum(table["n"].to_numpy()))
        return pa.table({"many": [0], "block": [table["block"][0].as_py()], "n": [n], "sums": pa.array([sums], pa.list_(pa.float64()))})

    made = texts.select("t").mapInArrow(run, "many long, block long, n double, sums array<float>")
    out = "many long, block long, n double, sums array<double>"
    for key in (["many", "block"], ["block"]):
        made = made.groupBy(*key).applyInArrow(add, out)
    blocks = made.orderBy("block").collect()  # one row per 4096 parameters
    if not blocks:
        return model.theta  # no training texts
    return np.concatenate([np.array(r["sums"]) / r["n"] for r in blocks]).astype(np.float32)


def score(docs: DataFrame, id_col: str, text_col: str, p: Params = Params()) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows with crc32(id as text) mod 10 = 0 are held out; counts and network come from all others
    (null ids train). A null or blank text is the end token alone. Repeated rows are scored alike.
    The score is log10 of the product over the tokens of P(class | text so far) P(word | class):
    words of the head from the network, other words as their smoothed share of their tail class,
    all unseen words being one word of each class. Without training texts the untrained network
    scores. Rare words' counts are joined by word, so no table of the vocabulary is broadcast.
    """
    rows = docs.select(F.col(id_col).cast("string").alias("key"), utf8(text_col).alias("t"))
    training = rows.where(~held_out("key", 10, 0))
    counts = written(count_words(training), "word-counts")
    vocab = vocabulary(counts, p)
    theta = train(training, vocab, p)
    shape = gru.Shape(vocab.head, p.tails, p.hidden)
    shared = docs.sparkSession.sparkContext.broadcast((vocab, shape, theta))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, shape, theta = shared.value
        model = gru.Gru(shape, theta)
        lookup = Lookup(vocab)
        base_of, within_of = vocab.base(lookup.c), np.zeros(len(lookup.c))
        tail = lookup.symbols >= vocab.head
        within_of[tail] = vocab.within_tail(lookup.c[tail], lookup.symbols[tail] - vocab.head)

        def read(batch: pa.RecordBatch) -> pa.RecordBatch:
            """Symbols, key, known tokens, base and tail terms of the words whose counts are here, and the
            other words with their numbers."""
            symbols, at, ends, words = lookup.documents(batch.column(1))
            starts, here = symbols.offsets.to_numpy(), at >= 0
            n_known = np.add.reduceat(here & (lookup.c[at] > 0), starts[:-1], dtype=np.int64)
            base = np.add.reduceat(np.where(here, base_of[at], 0.0), starts[:-1])
            within = np.add.reduceat(np.where(here, within_of[at], 0.0), starts[:-1])
            inner = np.ones(len(at), bool)
            inner[starts[1:] - 1] = False
            rare = np.flatnonzero(~here[inner])
            coded = words.take(pa.array(rare)).dictionary_encode()
            owner = np.searchsorted(ends, rare, side="right") - 1
            width = max(len(coded.dictionary), 1)
            pairs, times = np.unique(owner * width + coded.indices.to_numpy(), return_counts=True)
            offsets = pa.array(np.searchsorted(pairs, np.arange(len(starts)) * width).astype(np.int32))
            return pa.record_batch(
                [
                    symbols,
                    pa.array(batch.column(0).to_pylist(), pa.string()),  # the column would hold the batch's texts
                    pa.array(n_known, pa.int64()),
                    pa.array(base),
                    pa.array(within),
                    pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(pairs % width))),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                ],
                ["symbols", "key", "n_known", "base", "within", "rare", "times"],
            )

        for held in _buffered(batches, p, read):
            docs = _arrays(held["symbols"])
            logp = gru.score(model, docs, p.lanes, p.steps, 0) / np.log(10) + held["within"].to_numpy()
            held = held.append_column("n_tokens", pa.array([len(x) for x in docs], pa.int64())).append_column("logp", pa.array(logp))
            yield from held.select(["key", "n_tokens", "n_known", "base", "logp", "rare", "times"]).to_batches()

    schema = "key string, n_tokens long, n_known long, base double, logp double, rare array<binary>, times array<int>"
    scored = numbered(rows.select("key", "t").mapInArrow(run, schema), "scored")
    a = p.smoothing
    tail = (F.crc32(F.expr("substring(word, -2, 2)")) % p.tails).cast("int")
    c = F.coalesce("c", F.lit(0)) + a
    sizes = F.lit((vocab.tail_n + a * (vocab.tail_v + 1)).tolist())
    rare = scored.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("_row", F.col("x.rare").alias("word"), F.col("x.times").alias("k"))
    joined = rare.join(counts, "word", "left")
    extra = joined.groupBy("_row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).cast("long").alias("more"),
        F.sum(F.col("k") * F.log10(c / (vocab.n + a * (vocab.v + 1)))).alias("base2"),
        F.sum(F.col("k") * F.log10(c / F.get(sizes, tail))).alias("logp2"),
    )
    doc_id = F.col("key").cast(docs.schema[id_col].dataType)
    return scored.select("_row", doc_id.alias("doc_id"), "n_tokens", "n_known", "base", "logp").join(extra, "_row", "left").select(
        "doc_id",
        held_out("doc_id", 10, 0).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(vocab.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (F.col("logp") + F.coalesce("logp2", F.lit(0.0))).alias("score"),
    )
