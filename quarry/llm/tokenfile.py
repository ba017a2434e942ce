"""Token ids of whole documents as ORC files: run-length encoded integers in stripes, row indexes, and
Bloom filters on the document ids.

``write`` range-partitions the texts by document id, encodes each partition in that order and writes
it as files of one row per document: doc_id, part, start (ids before it in its part), n_tokens and
ids. Parts follow each other, so a document's place among all ids is its place in the part plus the
ids of earlier parts, which ``offsets`` takes from the narrow columns. Readers split files at their
stripes and skip stripes and row groups by their statistics and Bloom filters.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

END_ID = 1
CACHE = 1 << 18  # pieces of words that a worker's encoder remembers in each of two generations
LONGEST = 64  # bytes of a piece that is remembered
PART = 4 << 20  # characters of text encoded at a time
SCHEMA = "doc_id long, part int, start long, n_tokens long, ids array<int>"
#: What the files are written with. A stripe is what one task reads at least; row groups of 1,000
#: documents each have statistics and a Bloom filter of their document ids.
OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(16 << 20),
    "orc.row.index.stride": "1000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


class Memory:
    """What was found for the last keys: two generations, so that frequent keys survive a full one."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def find(self, keys: list) -> list:
        young, old = self.young.get, self.old.get
        return [young(k) or old(k) for k in keys]

    def keep(self, found: dict) -> None:
        if len(self.young) + len(found) > self.size:
            self.old, self.young = self.young, {}
        self.young.update(found)


WHITE, LETTER, DIGIT, OTHER, WHOLE = range(5)


def _bytes(*spans: tuple[int, int]) -> list[int]:
    return [b for lo, hi in spans for b in range(lo, hi + 1)]


class Encoder:
    """Ids of a tokenizers file.

    The file's normalizer and pre-tokenizer split at white space and drop it, lower every character, and cut
    words into pieces: runs of letters, single digits, runs of other characters, and a few endings after an
    apostrophe. Texts are cut here at ASCII white space and, in words of printable ASCII and the accented
    letters of Latin-1, which the normalizer only lowers, into those pieces; the library's model gets each
    distinct piece that is not remembered once. Words with an apostrophe are cut by the file's own pattern,
    words with any other character, or with what may be a special token, go through the library whole.
    Tests compare this with the library on whole texts. Files of another build are refused by ``usable``.
    """

    # The file's normalizers, and its pattern of pieces.
    NORMALIZERS = ["NFC", "Replace", "Lowercase"]
    PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    SPLIT = re.compile(PIECES.replace(r"\p{L}", "a-zß-öø-ÿ").replace(r"\p{N}", "0-9").replace(r"\s", ""))

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            if not self.usable(json.load(f)):
                raise ValueError(f"{path} does not drop white space between words, or splits words another way")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        printable = _bytes((33, 126), (161, 172), (174, 255))  # bytes that stand for themselves
        rest = sorted(set(range(256)) - set(printable))
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}
        self.memory = Memory(CACHE)
        self.kinds = np.full(256, OTHER, np.uint8)
        self.kinds[_bytes((9, 13), (32, 32))] = WHITE
        self.kinds[_bytes((48, 57))] = DIGIT
        self.kinds[_bytes((65, 90), (97, 122), (0x80, 0xBF), (0xC3, 0xC3))] = LETTER
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.odd = np.zeros(256, bool)  # bytes whose words are not cut here
        self.odd[[*_bytes((0, 8), (14, 31)), ord("'"), 127, *_bytes((0xC0, 0xC2), (0xC4, 0xFF))]] = True

    @classmethod
    def usable(cls, spec: dict) -> bool:
        normalizers = (spec.get("normalizer") or {}).get("normalizers", [])
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        return (
            [n["type"] for n in normalizers] == cls.NORMALIZERS
            and [s["type"] for s in steps] == ["Split", "ByteLevel"]
            and steps[0]["pattern"] == {"Regex": cls.PIECES}
            and steps[0]["invert"]
            and all(t["content"].startswith("<|") for t in spec["added_tokens"])
        )

    def ids(self, piece: bytes) -> bytes:
        """Ids of a piece, or of a word that was not cut."""
        if piece.isascii() and b"'" not in piece and b"<|" not in piece and piece.isalnum():
            return self.piece(piece.decode())
        text = piece.decode()
        if "<|" in text or not self.PLAIN.fullmatch(text):
            return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.piece, self.SPLIT.findall(text.lower())))

    def piece(self, piece: str) -> bytes:
        mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenize(mapped)]).tobytes()

    def pieces(self, text: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """(pieces, where each starts) of UTF-8 text that ends in white space."""
        kind, low = self.kinds[text], self.lower[text]
        accent = np.flatnonzero(text[:-1] == 0xC3) + 1
        second = text[accent]
        low[accent] = np.where((second <= 0x9E) & (second != 0x97), second + 0x20, second)
        sign = accent[(second == 0x97) | (second == 0xB7)]
        marker = np.flatnonzero((text[:-1] == ord("<")) & (text[1:] == ord("|")))
        odd = np.concatenate([np.flatnonzero(self.odd[text]), sign, marker])
        if len(odd):
            word = np.cumsum(kind == WHITE, dtype=np.int32)
            whole = np.zeros(int(word[-1]) + 1, bool)
            whole[word[odd]] = True
            at = whole[word] & (kind != WHITE)
            kind[at], low[at] = WHOLE, text[at]
        edge = np.empty(len(kind), bool)  # whether a byte does not go on what stands before it
        edge[:1] = True
        edge[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        inside = kind != WHITE
        starts = np.flatnonzero(edge & inside)
        data = low[inside]
        offsets = np.append((np.cumsum(inside) - inside)[starts], len(data)).astype(np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]), starts

    def encode(self, texts: list[str], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each with ``end_id`` after it, and how many each text has)."""
        raw = [t.encode() for t in texts]
        borders = np.cumsum([len(r) + 1 for r in raw], dtype=np.int64)
        pieces, starts = self.pieces(np.frombuffer(b"".join([r + b"\n" for r in raw]), np.uint8))
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        blobs = [b or self.ids(p) for p, b in zip(distinct, self.memory.find(distinct), strict=True)]
        self.memory.keep({p: b for p, b in zip(distinct, blobs, strict=True) if len(p) <= LONGEST})
        blobs.append(array("I", [end_id]).tobytes())
        each = np.array([len(b) // 4 for b in blobs], np.int64)
        first = np.cumsum(each) - each
        upto = np.searchsorted(starts, borders)  # pieces up to the end of each text
        codes = np.insert(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), upto, len(blobs) - 1)
        sizes = each[codes]
        ends = np.cumsum(sizes)
        places = np.repeat(first[codes] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        last = upto + np.arange(len(texts))
        return np.frombuffer(b"".join(blobs), "<u4")[places], np.diff(ends[last], prepend=0)


@lru_cache(1)
def encoder(path: str) -> Encoder:
    """One per worker, whatever tasks it runs."""
    return Encoder(path)


def write(docs: DataFrame, id_col: str, text_col: str, path: str, vocabulary: str, end_id: int = END_ID) -> None:
    """Write the ids of every text, each followed by ``end_id``, under ``path`` by ascending document id.

    A null or empty text is ``end_id`` alone. Null ids come first; rows with one id follow each other by
    a hash of their text, equal rows in any order, and the range partitions may split between them, so a
    repeated id overloads no task. Other columns are ignored; an empty table writes no rows. Integer ids
    only. Texts move once, before they are encoded; a lost partition is encoded again.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    order = ["doc_id", "_tie", "_row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        enc = encoder(vocabulary)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            at, size = 0, 0
            texts = batch["text"].to_pylist()
            for i, text in enumerate(texts):
                size += len(text)
                if size < PART and i < len(texts) - 1:
                    continue
                ids, sizes = enc.encode(texts[at : i + 1], end_id)
                ends = np.concatenate([[0], np.cumsum(sizes)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.view("<i4")))
                parts = pa.array(np.full(len(sizes), part, np.int32))
                columns = [batch["doc_id"][at : i + 1], parts, pa.array(start + ends[:-1]), pa.array(sizes), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "part", "start", "n_tokens", "ids"])
                start += int(ends[-1])
                at, size = i + 1, 0

    writer = placed.mapInArrow(encode, SCHEMA).write.format("orc")
    for k, v in OPTIONS.items():
        writer = writer.option(k, v)
    writer.save(path)


def read(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None, low: int | None = None, high: int | None = None) -> DataFrame:
    """The files' rows, of the given document ids or from ``low`` to ``high`` if those are stated. The
    conditions reach the ORC reader, which leaves out the stripes and row groups that they rule out."""
    rows = spark.read.schema(SCHEMA).orc(path)
    if doc_ids is not None:
        rows = rows.where(F.col("doc_id").isin([int(i) for i in doc_ids]))
    if low is not None:
        rows = rows.where(F.col("doc_id") >= low)
    if high is not None:
        rows = rows.where(F.col("doc_id") <= high)
    return rows


def offsets(spark: SparkSession, path: str) -> DataFrame:
    """(part, base): the ids of all earlier parts, one row per part, from two narrow columns. The window
    over all parts holds as many rows as the write had tasks."""
    sizes = spark.read.schema(SCHEMA).orc(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def ids_crc32(ids: str | Column) -> Column:
    """Unsigned crc32 of an array of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for a in batches:
            flat = a.flatten().to_numpy(zero_copy_only=False).astype("<u4", copy=False)
            at = (4 * (a.offsets.to_numpy() - a.offsets[0].as_py())).astype(np.int32)
            yield pa.BinaryArray.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(at), pa.py_buffer(flat.tobytes())])

    return F.crc32(packed(ids))


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start (ids of all documents before it), n_tokens, ids.
    The offsets are one row per part, which is broadcast: at most the write's tasks."""
    rows = read(spark, path).join(F.broadcast(offsets(spark, path)), "part")
    return rows.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids")
