"""Partitioned execution: md5 shard placement, two-level top-k, late materialisation, splits.

Shards are a column, not processes: ``repartition("shard")`` co-locates a shard's rows, and a
per-shard top-k followed by a global top-k is the scatter/gather of a sharded search engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_mod
from quarry.operators.rank import topk_batch


def assign_shard(df: DataFrame, id_col: str, n: int, out: str = "shard") -> DataFrame:
    """shard = int(md5(str(id)), 16) % n."""
    return df.withColumn(out, md5_mod(F.col(id_col), n).cast("int"))


def shard_counts(df: DataFrame, id_col: str, n: int) -> DataFrame:
    return assign_shard(df, id_col, n).groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"))


def sharded_topk(scored: DataFrame, k: int, group: str = "query_id", id_col: str = "doc_id") -> DataFrame:
    """Best k within (shard, group), then best k within group; equals the unsharded top-k."""
    local = topk_batch(scored, ["shard", group], k, id_col=id_col).drop("rank")
    return topk_batch(local, group, k, id_col=id_col)


def late_materialize(top: DataFrame, docs: DataFrame, id_col: str, fields: dict) -> DataFrame:
    """Fetch stored fields only for the winners (a keyed join cannot misalign ids and fields).

    ``top`` holds at most k rows per query; AQE broadcasts it if it measures small. ``fields``
    (name -> Column over ``docs``) are computed after the join, i.e. only for the winners."""
    joined = docs.withColumnRenamed(id_col, "doc_id").join(top, "doc_id")
    return joined.select(*top.columns, *[c.alias(n) for n, c in fields.items()])


def split_shards(df: DataFrame, id_col: str, n: int) -> DataFrame:
    """n -> 2n shards: rows whose hash % 2n == s + n move from shard s to s + n; others stay."""
    return (
        df.select(md5_mod(F.col(id_col), n).cast("int").alias("old_shard"), md5_mod(F.col(id_col), 2 * n).cast("int").alias("new_shard"))
        .groupBy("old_shard", "new_shard")
        .agg(F.count(F.lit(1)).alias("n_docs"))
    )
