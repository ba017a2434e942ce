"""WARC archives: a writer of per-record gzip members and a splittable reader."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import utf8

MAGIC = b"\x1f\x8b\x08"
#: A gzip member of no bytes. It stands between records as the line end of Spark's text writer.
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00" + b"\x00" * 8
DATE = "2025-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
RECORD_SCHEMA = (
    "path string, record_offset long, record_type string, record_id string, refers_to string, target_uri string, "
    "payload_digest string, payload_bytes long, payload binary"
)


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(rid, url, payload: bytes, size: int, digest: str, refers) -> bytes:
    """One gzip member with one record. ``refers`` not null: a revisit without payload."""
    kind = "response" if refers is None else "revisit"
    block = HTTP.format(size).encode() + (payload if refers is None else b"")
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{'' if rid is None else rid}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + quote(url, safe="!#$%&'()*+,/:;=?@[]~"))
    if refers is not None:
        lines += [
            f"WARC-Refers-To: <urn:record:{refers}>",
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
        ]
    lines += [
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write_archives(df: DataFrame, path: str, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int = 0) -> None:
    """Write one record per row (payload: the column in UTF-8, null empty) below ``path``.

    Of rows with equal payloads of at least ``min_revisit_bytes`` bytes, the one with the largest
    id is a response and the others are revisits that refer to it; shorter payloads are all
    responses. Repeated rows of the largest id are all responses; a group without any id too. Null
    urls give records without a target. The payloads move once, to meet the table of repeated
    digests (a hot digest is one row there, and AQE splits the other side).
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), utf8(payload_col).alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("sha1", F.sha1("payload"))
    first = (
        rows.where(F.col("size") >= min_revisit_bytes)
        .groupBy(F.col("sha1").alias("d"), F.col("size").alias("n"))
        .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("copies"))
        .where("copies > 1 AND first IS NOT NULL")
        .drop("copies")
    )
    rows = rows.join(first, (F.col("sha1") == F.col("d")) & (F.col("size") == F.col("n")), "left")
    again = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    rows = rows.select(
        "id", "url", F.when(~again, F.col("payload")).alias("payload"), "size", "sha1", F.when(again, F.col("first")).alias("refers")
    )

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            ids, refers = pdf["id"].astype(object), pdf["refers"].astype(object)
            for i, u, p, n, d, r in zip(ids, pdf["url"], pdf["payload"], pdf["size"], pdf["sha1"], refers, strict=True):
                digest = base64.b32encode(bytes.fromhex(d)).decode()
                out.append(record(None if pd.isna(i) else i, u, bytes(p or b""), n, digest, None if pd.isna(r) else r))
            yield pd.DataFrame({"member": out})

    as_text = rows.withColumns({"id": F.col("id").cast("string"), "refers": F.col("refers").cast("string")})
    # a cast from binary keeps the bytes, and the text writer copies them: committed files on any store
    (
        as_text.mapInPandas(members, "member binary")
        .select(F.col("member").cast("string").alias("value"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .text(path)
    )


def _store_path(path: str) -> str:
    """Hadoop writes file:/x, pyarrow wants file:///x."""
    return "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path


def parse_member(data: bytes) -> dict | None:
    """A decoded member as a record, or None if it is none (such as the empty member)."""
    if not data.startswith(b"WARC/"):
        return None
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        k, _, v = line.partition(b":")
        fields[k.strip().lower().decode()] = v.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind = fields.get("warc-type")
    if not http.startswith(b"HTTP/"):
        payload = block
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    urn = lambda s: s[1:-1].removeprefix("urn:record:") if s else None
    if kind == "response":
        digest, size = base32_sha1(payload), len(payload)
    else:
        size, payload = int(fields.get("x-payload-length", 0)), None
    return {
        "record_type": kind,
        "record_id": urn(fields.get("warc-record-id")),
        "refers_to": urn(fields.get("warc-refers-to")),
        "target_uri": fields.get("warc-target-uri"),
        "payload_digest": digest,
        "payload_bytes": size,
        "payload": payload,
    }


def members_in(file, start: int, end: int, chunk: int = 1 << 20) -> Iterator[tuple[int, bytes]]:
    """(offset, decoded bytes) of the gzip members that start in [start, end) of a seekable file.

    From ``start`` on, each occurrence of the gzip magic is a candidate; the first that decodes to
    a WARC head (or to an empty member) is a true start, and from there each member ends where the
    next begins. Chance matches inside compressed data don't decode to a head and are passed over.
    Only the member being decoded and a chunk are held.
    """
    buf, base = b"", start  # buf holds the bytes from file offset base on
    file.seek(start)

    def more() -> bool:
        nonlocal buf
        got = file.read(chunk)
        buf += got
        return bool(got)

    def decode(at: int) -> tuple[bytes, int] | None:
        """The whole member at buffer position ``at`` and its length."""
        z, out, pos = zlib.decompressobj(31), [], at
        seen, judged = 0, False
        while True:
            if pos >= len(buf) and not more():
                return None
            part, pos = buf[pos:], len(buf)
            try:
                got = z.decompress(part)
            except zlib.error:
                return None
            out.append(got)
            seen += len(got)
            if not judged and (seen >= 5 or z.eof):
                if seen and not b"".join(out)[:5].startswith(b"WARC/"[:seen]):
                    return None
                judged = True
            if z.eof:
                return b"".join(out), len(buf) - len(z.unused_data) - at

    at = 0
    while True:
        found = buf.find(MAGIC, at)
        while found < 0:
            keep = max(at, len(buf) - 2)
            buf, base, at = buf[keep:], base + keep, 0
            if base >= end or not more():
                return
            found = buf.find(MAGIC)
        if base + found >= end:
            return
        buf, base = buf[found:], base + found
        got = decode(0)
        if got is None:
            at = 1
            continue
        data, size = got
        if data:
            yield base, data
        buf, base, at = buf[size:], base + size, 0


def read_archives(spark: SparkSession, path: str, split_bytes: int = 16 << 20) -> DataFrame:
    """Records of all archives below ``path`` (RECORD_SCHEMA), wherever the files were made.

    Spark lists the files; each is cut into byte ranges of ``split_bytes`` and each range is a task
    that owns the records starting inside. Digest and size of a response are those of the payload
    read; a revisit has those its head states and a null payload. The tasks open ranges through
    pyarrow's file systems (local and shared folders, object stores, HDFS).
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    ranges = files.select("path", "length", F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start"))
    ranges = ranges.withColumn("end", F.least(F.col("start") + split_bytes, F.col("length")))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        for pdf in batches:
            for p, s, e in zip(pdf["path"], pdf["start"], pdf["end"], strict=True):
                store, inner = fs.FileSystem.from_uri(_store_path(p))
                rows, held = [], 0
                with store.open_input_file(inner) as f:
                    for offset, data in members_in(f, int(s), int(e)):
                        if (r := parse_member(data)) is not None:
                            rows.append({"path": p, "record_offset": offset} | r)
                            held += len(data)
                        if held > 8 << 20:
                            yield pd.DataFrame(rows)
                            rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows)

    n = max(1, ranges.count())
    cols = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]

    def ordered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in scan(batches):
            yield pdf[cols]

    return ranges.repartition(n, "path", "start").mapInPandas(ordered, RECORD_SCHEMA)
