"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_written, numbered, trim, utf8, written
from quarry.llm.graph import components

VOCABULARY = 1 << 17  # words whose hashes a task remembers at a time


@dataclass(frozen=True)
class Params:
    """Shingles of ``words`` words; documents are linked at a Jaccard similarity of ``percent`` / 100
    or more. ``bands`` x ``rows`` signature coordinates: a pair at exactly 0.8 meets in no band with
    probability (1 - 0.8**5)**36 = 6e-7. Of two documents in one band, those whose sketches (two bits
    of each coordinate) differ in more than ``sketch_bits`` bits are not compared: at 0.8, 36 are
    expected and 70 are 5 deviations off (3e-7). ``progress``: rounds of stars go on while they link
    at least this share of the nodes still open; then the rest is compared in blocks of at most
    ``block`` nodes and about ``block_bytes`` bytes of text."""

    words: int = 4
    percent: int = 80
    bands: int = 36
    rows: int = 5
    sketch_bits: int = 70
    progress: float = 0.1
    block: int = 512
    block_bytes: int = 16 << 20


class Words(dict):
    """64-bit hash of a word, remembered for up to VOCABULARY words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= VOCABULARY:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingles(text: bytes, k: int, words: Words) -> np.ndarray:
    """Distinct 64-bit hashes of the k-word shingles, sorted. Words end at ASCII white space and A-Z
    are lowered; fewer than k words are one shingle, no words none."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(words.__getitem__, tokens), np.uint64, len(tokens))
    n = min(k, len(h))
    out = np.full(len(h) - n + 1, np.uint64(n))
    for i in range(n):
        out = (out ^ h[i : len(h) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(s: np.ndarray, coordinates: int, piece: int = 512) -> np.ndarray:
    """C-MinHash: coordinate k is the least pi(sigma(v) - k) over the set, of two permutations pi and
    sigma of the 32-bit circle; shifting pi's argument replaces one permutation per coordinate."""
    x = _mix((s >> np.uint64(32)).astype(np.uint32) ^ (s & np.uint64(0xFFFFFFFF)).astype(np.uint32) ^ np.uint32(0x5BD1E995))
    shift = np.arange(1, coordinates + 1, dtype=np.uint32)[:, None]
    out = np.full(coordinates, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), piece):
        np.minimum(out, _mix(x[None, at : at + piece] - shift).min(axis=1), out=out)
    return out


SKETCH = 6  # 64-bit words


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits each of the coordinates (at most 32 x SKETCH), packed into 64-bit words."""
    bits = np.zeros((32 * SKETCH, 2), np.uint8)
    n = min(len(sig), len(bits))
    bits[:n, 0], bits[:n, 1] = sig[:n] & 1, (sig[:n] >> 1) & 1
    return np.packbits(bits.ravel()).view(np.int64)


def _signatures(p: Params):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words()
        seeds = np.arange(p.bands, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for texts in batches:
            n, bands, sketches, at = [], [], [], [0]
            for t in texts:
                s = shingles(t.as_py(), p.words, words)
                n.append(len(s))
                if len(s):
                    sig = signature(s, p.bands * p.rows)
                    h = seeds.copy()
                    for r in range(p.rows):
                        h = (h ^ sig[r * p.bands : (r + 1) * p.bands].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                        h ^= h >> np.uint64(31)
                    bands.append(h.view(np.int64))
                    sketches.append(sketch(sig))
                at.append(len(bands))
            size = np.diff(at)
            empty = np.zeros(0, np.int64)
            rows = pa.StructArray.from_arrays(
                [
                    pa.array(n, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size * p.bands)]), pa.int32()), np.concatenate([empty, *bands])),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size * SKETCH)]), pa.int32()), np.concatenate([empty, *sketches])),
                ],
                ["n", "bands", "sketch"],
            )
            yield rows
        words.clear()
        trim()

    return F.arrow_udf(_typed(run), "struct<n: long, bands: array<long>, sketch: array<long>>")


def _typed(run):
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def _jaccard(p: Params):
    """Whether the full shingle sets of two texts reach the similarity."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        words = Words()
        for left, right in batches:
            out, last, seen = [], None, None
            for a, b in zip(left, right, strict=True):
                if a != last:
                    last, seen = a, shingles(a, p.words, words)
                t = shingles(b, p.words, words)
                both = len(np.intersect1d(seen, t, assume_unique=True))
                out.append(100 * both >= p.percent * (len(seen) + len(t) - both))
            yield pd.Series(out, dtype=bool)
        words.clear()
        trim()

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "boolean")


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, p: Params = Params()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Rows are linked when their shingle sets reach the similarity; component_id is the smallest id
    reachable, kept whether that is the row's own. Null, empty and blank texts have no shingles and
    are linked with nothing. Rows of equal text are one node from the start, so a third of the
    corpus in one text is one node. Rows that repeat an id are rows of their own (all with the
    smallest id are kept); a null id is no smallest id, and a component of null ids has a null id
    and keeps none.
    """
    tagged = _tagged(docs, id_col, text_col, p)
    smallest = written(tagged.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "smallest")
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return tagged.join(smallest, "comp").select("doc_id", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def deduplicate(docs: DataFrame, id_col: str, text_col: str, p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` of which one stays per component: that with the smallest id (null ids
    last). Rows equal in id and text are one document, also without words; one of them stays."""
    tagged = _tagged(docs, id_col, text_col, p)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row", "text_id")).alias("first")
    keep = tagged.groupBy("comp").agg(first).select(F.col("first.doc_id").alias("_i"), F.col("first.text_id").alias("_t")).distinct()
    rows = docs.select(F.struct("*").alias("in"))
    rows = rows.select("in", F.col("in")[id_col].alias("i"), F.unhex(F.md5(utf8(F.col("in")[text_col]))).alias("t"))
    out = rows.join(keep, F.col("i").eqNullSafe(F.col("_i")) & (F.col("t") == F.col("_t")), "left_semi").dropDuplicates(["i", "t"])
    return out.select(*[F.col("in")[c].alias(c) for c in docs.columns])


def _tagged(docs: DataFrame, id_col: str, text_col: str, p: Params) -> DataFrame:
    """(_row, doc_id, text_id, n, comp) per row.

    1. Signatures, in a written table; equal texts fold into a node.
    2. Rounds of stars: in each band bucket that spans several components, every node sees a single
       leader (the least of the bucket by a new order each round), and of the leaders it sees, the
       one it shares most buckets with is tested on full sets, if its size and sketch allow it. That
       settles large groups in a few rounds of at most one test per node.
       Between rounds the components that links join are merged by two steps of labels, not to the end;
       all links are followed to the end once, when the rounds are over.
    3. When rounds link little more, the nodes of buckets that still span several components are
       gathered into clusters (connected through those buckets) and compared in blocks: within a
       task, every pair that shares a band but no component, with sizes and sketches that allow the
       similarity, is tested, so no link that banding finds is missing, and only links come back.
       A cluster of c nodes costs c / block copies of its texts and c**2 sketch comparisons.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("t"))
    rows = rows.select("doc_id", F.unhex(F.md5("t")).alias("text_id"), _signatures(p)("t").alias("s")).select("doc_id", "text_id", "s.*")
    rows = numbered(rows, "signatures")
    full = rows.where("n > 0")
    nodes = full.groupBy("text_id").agg(F.min("_row").alias("node"), F.count(F.lit(1)).alias("copies"))
    reps = written(full.join(nodes.select(F.col("node").alias("_row")), "_row", "left_semi"), "representatives")
    buckets = reps.select(F.col("_row").alias("node"), F.posexplode("bands").alias("band", "h"))
    buckets = buckets.select("node", "band", F.xxhash64("band", "h").alias("bucket"))
    # only buckets with company go on
    # (such sides are written first: a join of plain shuffles is one that AQE can split at a hot bucket)
    company = written(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("bucket"), "company")
    buckets = written(buckets.join(company, "bucket"), "buckets")
    open_ = buckets.withColumn("comp", F.col("node"))
    involved = buckets.select("node").distinct()
    texts = _texts(docs, id_col, text_col, reps, involved)
    traits = written(reps.join(involved.withColumnRenamed("node", "_row"), "_row", "left_semi").select(F.col("_row").alias("node"), "n", "sketch", "bands"), "traits")

    tested = None  # pairs (a < b) tested so far, with their verdict
    turn = 0
    while True:
        order = F.struct(F.xxhash64("node", F.lit(turn)).alias("rank"), F.col("node").alias("node"), F.col("comp").alias("comp"))
        leader = written(open_.groupBy("bucket").agg(F.min(order).alias("lead")), "leaders")
        tries = open_.join(leader, "bucket").where(F.col("comp") != F.col("lead.comp"))
        seen = tries.groupBy("node", "comp", F.col("lead.node").alias("lead"), F.col("lead.comp").alias("over")).agg(F.count(F.lit(1)).alias("shared"))
        best = seen.groupBy("node", "comp").agg(F.max(F.struct("shared", "lead", "over")).alias("x"))
        first = F.col("node") < F.col("x.lead")
        ends = [F.col("node"), F.col("comp")], [F.col("x.lead"), F.col("x.over")]
        named = zip(("a", "ca"), ("b", "cb"), *ends, strict=True)
        best = best.select(*[c for p_, q_, x, y in named for c in (F.when(first, x).otherwise(y).alias(p_), F.when(first, y).otherwise(x).alias(q_))])
        best = best.distinct() if tested is None else _untested(best.distinct(), tested)
        new = _tested(_alike(best, traits, p), texts, p, f"stars-{turn}")
        linked = new.where("same").count()
        tested = new if tested is None else tested.union(new)
        open_ = _mixed(_relabelled(open_, new.where("same")))
        left = open_.select("node").distinct().count()
        turn += 1
        if linked <= p.progress * left:
            break
    comp = written(components(tested.where("same").select("a", "b")), "stars")
    whole = open_.drop("comp").join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    links = written(_rest(_mixed(whole), traits, texts, p), "rest")
    comp = written(components(links.union(comp.select(F.col("node").alias("a"), F.col("comp").alias("b")))), "final")

    member = nodes.join(comp.select("node", "comp"), "node", "left").select(F.col("text_id").alias("_t"), F.coalesce("comp", "node").alias("comp"))
    out = rows.join(member, F.col("text_id") == F.col("_t"), "left")
    return out.select("_row", "doc_id", "text_id", "n", F.coalesce("comp", "_row").alias("comp"))


def _texts(docs: DataFrame, id_col: str, text_col: str, reps: DataFrame, involved: DataFrame) -> DataFrame:
    """(node, t): the text of every node that shares a bucket, written once."""
    need = reps.join(involved.withColumnRenamed("node", "_row"), "_row", "left_semi").select(F.col("_row").alias("node"), F.col("doc_id").alias("i"), "text_id")
    source = docs.select(F.col(id_col).alias("doc_id"), utf8(text_col).alias("t"))
    found = source.join(need, F.col("doc_id").eqNullSafe(F.col("i")) & (F.unhex(F.md5("t")) == F.col("text_id")))
    return written(found.select("node", "t").dropDuplicates(["node"]), "texts")


def _rest(open_: DataFrame, traits: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """(a, b): links between components that share a bucket, found block by block."""
    lead = written(open_.groupBy("bucket").agg(F.min("node").alias("lead")), "cluster-leads")
    edges = open_.join(lead, "bucket").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    cluster = components(edges, "clusters").select("node", F.col("comp").alias("cluster"))
    member = open_.select("node", "comp").distinct().join(cluster, "node").join(traits, "node").join(texts, "node")
    size = cluster.join(texts.select("node", F.octet_length("t").alias("bytes")), "node").groupBy("cluster")
    size = written(size.agg(F.count(F.lit(1)).alias("c"), F.sum("bytes").alias("bytes")), "cluster-sizes")
    parts = F.greatest(F.ceil(F.col("c") / p.block), F.ceil(F.col("bytes") / p.block_bytes)).cast("int")
    member = member.join(size.select("cluster", parts.alias("parts")), "cluster")
    member = member.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    member = member.withColumn("other", other).drop("parts")
    member = member.withColumn("lo", F.least("part", "other")).withColumn("hi", F.greatest("part", "other")).drop("other")
    return member.groupBy("cluster", "lo", "hi").applyInArrow(_compare(p), "a long, b long")


def _compare(p: Params):
    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        node, comp, n, part = (table[c].to_numpy() for c in ("node", "comp", "n", "part"))
        bands = table["bands"].chunk(0).flatten().to_numpy().reshape(len(node), -1)
        sketches = table["sketch"].chunk(0).flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        lo, hi = table["lo"][0].as_py(), table["hi"][0].as_py()
        words, sets, texts = Words(), {}, table["t"]

        def shingles_of(i: int) -> np.ndarray:
            if i not in sets:
                sets[i] = shingles(texts[i].as_py(), p.words, words)
            return sets[i]

        root = {int(c): int(c) for c in comp}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        left, right = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
        tries = []
        for i in left:
            j = right[right > i] if lo == hi else right
            ok = (comp[j] != comp[i]) & (100 * np.minimum(n[i], n[j]) >= p.percent * np.maximum(n[i], n[j]))
            j = j[ok]
            j = j[(bands[j] == bands[i]).any(axis=1)]
            apart = np.bitwise_count(sketches[j] ^ sketches[i]).sum(axis=1)
            tries += [(int(d), int(i), int(k)) for d, k in zip(apart, j, strict=True) if d <= p.sketch_bits]
        out = []
        for _, i, j in sorted(tries):  # the likeliest first: a link spares the other pairs of its components
            a, b = find(int(comp[i])), find(int(comp[j]))
            if a == b:
                continue
            x, y = shingles_of(i), shingles_of(j)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if 100 * both >= p.percent * (len(x) + len(y) - both):
                root[a] = b
                out.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _sized(n: str, m: str, p: Params):
    """Whether two set sizes allow the similarity."""
    return 100 * F.least(n, m) >= p.percent * F.greatest(n, m)


def _apart(x: str, y: str):
    """Bits in which two sketches differ."""
    out = F.lit(0)
    for i in range(SKETCH):
        out = out + F.bit_count(F.col(x)[i].bitwiseXOR(F.col(y)[i]))
    return out


def _alike(pairs: DataFrame, traits: DataFrame, p: Params) -> DataFrame:
    """The pairs (columns a, b and others) whose sizes and sketches allow the similarity."""
    a = traits.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = traits.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").where(_sized("na", "nb", p) & (_apart("sa", "sb") <= p.sketch_bits))
    return both.select(*pairs.columns)


def _untested(pairs: DataFrame, tested: DataFrame) -> DataFrame:
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def _relabelled(open_: DataFrame, links: DataFrame) -> DataFrame:
    """``open_`` with the components that the links (ca, cb) join partly merged: each takes the smallest of
    those that it is linked to, and then what that one took. Rows of one component after this are connected;
    what is still apart meets again in the next round, and all links are followed to the end once, after it."""
    ends = links.select(F.col("ca").alias("c"), F.col("cb").alias("o")).union(links.select(F.col("cb").alias("c"), F.col("ca").alias("o")))
    hook = written(ends.groupBy("c").agg(F.least(F.min("o"), F.col("c")).alias("m")), "hook")
    after = hook.select(F.col("c").alias("m"), F.col("m").alias("then"))
    jump = written(hook.join(after, "m", "left").select("c", F.coalesce("then", "m").alias("to")), "jump")
    moved = open_.join(jump, open_["comp"] == jump["c"], "left")
    return moved.select("bucket", "band", "node", F.coalesce("to", "comp").alias("comp"))


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows of buckets that span several components, written."""
    rows = written(rows, "labelled")
    several = rows.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("bucket")
    out = written(rows.join(written(several, "several"), "bucket"), "mixed")
    drop_written(rows)
    return out


def _tested(pairs: DataFrame, texts: DataFrame, p: Params, name: str) -> DataFrame:
    """The pairs with the verdict ``same`` of their full sets, written."""
    a = texts.select(F.col("node").alias("a"), F.col("t").alias("ta"))
    b = texts.select(F.col("node").alias("b"), F.col("t").alias("tb"))
    both = pairs.join(a, "a").join(b, "b")
    return written(both.select(*pairs.columns, _jaccard(p)("ta", "tb").alias("same")), name)
