"""Hash-based placement: 128-bit md5 modulo (shards, vocabulary samples) and term buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(col, m: int) -> Column:
    """int(md5(x), 16) % m, with x as UTF-8 text, computed exactly in BIGINT (m < 2^31).

    The 128-bit value is folded from four 32-bit pieces left to right: r = (r * 2^32 + piece) % m.
    """
    c = F.col(col) if isinstance(col, str) else col
    h = F.md5(c.cast("string"))
    r = F.lit(0).cast("bigint")
    for i in range(4):
        piece = F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("bigint")
        r = (r * F.lit(4294967296) + piece) % F.lit(m)
    return r


def term_bucket(col, buckets: int) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.pmod(F.xxhash64(c), F.lit(buckets)).cast("int")
