"""Sharding by weighted rendezvous hashing of stable record keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import numbered, ordinals

SALT = 20251


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Shard number with the highest weighted score for ``key``.

    Shard s scores -w_s / ln(u), u a hash of (key, s) in (0, 1): the maximum falls to s with
    probability w_s / sum(w). Only the key, the shard numbers and the weights decide, so one more
    shard takes rows only into itself and the other rows stay. A null key is a key of its own.
    """
    text = F.coalesce(key.cast("string"), F.lit("\x00null"))

    def score(s: int, w: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(F.lit(SALT), text, F.lit(s)), 11).cast("double") + 0.5) * F.lit(2.0**-53)
        return F.struct((F.lit(-float(w)) / F.log(u)).alias("score"), F.lit(-s).alias("s"))

    return (-F.array_max(F.array(*[score(s, w) for s, w in enumerate(weights)]))["s"]).cast("int")


def shard(
    df: DataFrame, key: str, text: str, weights: Sequence[float] = (1.0,) * 8, grown: Sequence[float] | None = None
) -> DataFrame:
    """One row per input row: key, size, text_crc32, shard, slot, grown_shard.

    size = UTF-8 bytes of the text (null: none) plus 1; text_crc32 unsigned (null text: that of no
    bytes); slot counts each shard's rows gaplessly from 0; grown_shard is the shard under
    ``grown`` (default: one more shard of the last weight). Null keys share one shard; repeated
    rows each get a row and a slot. An empty table gives no rows.
    """
    grown = list(weights) + [weights[-1]] if grown is None else grown
    rows = df.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        rendezvous(F.col(key), weights).alias("shard"),
        rendezvous(F.col(key), grown).alias("grown_shard"),
    )
    return ordinals(numbered(rows, "shards"), "shard", "slot").drop("_row")


def write_shards(df: DataFrame, key: str, path: str, weights: Sequence[float]) -> None:
    """Write whole rows under ``path``/shard=<n>/."""
    df.withColumn("shard", rendezvous(F.col(key), weights)).write.partitionBy("shard").parquet(path)
