"""A stored index for approximate nearest neighbours: hash tables over projections, probed by distance.

A hash table cuts the space by ``projections`` random sign directions into buckets: a vector's bucket is
the cell numbers of its projections. ``build`` writes, under one folder,

* ``buckets/slot=<n>``: (table_no, bucket, vec_id), a slot being a hash of the table and bucket,
* ``sizes``: one row per bucket with its number of vectors,
* ``vectors/part=<n>``: the vectors by a hash of their id,
* ``meta``: one row of parameters.

A search reads the index alone. It orders the stored buckets by the distance from the query to their
border and takes the nearest until they hold ``target`` vectors, reads the slots of those buckets, and
compares their vectors exactly. Buckets that hold no vector are never tried, and with a target of all
vectors the search is exact. ``calibrate`` measures which target reaches a wanted recall.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions import vectors as VF
from quarry.operators import rank as R
from quarry.operators import vector as V
from quarry.operators.util import stored

TABLES = 10
SLOTS = 64  # folders of buckets, and of vectors
WIDTH = 1.5  # width of a cell, in standard deviations of a projection


@dataclass(frozen=True)
class Params:
    tables: int
    projections: int
    dim: int
    width: float


def signs(table: int, projection: int, dim: int) -> str:
    """The direction of a projection: a + or - for each dimension, from digests."""
    bits = ""
    while len(bits) < dim:
        digest = hashlib.md5(f"{table}:{projection}:{len(bits)}".encode()).digest()
        bits += "".join("+-"[b >> i & 1] for b in digest for i in range(8))
    return bits[:dim]


def shift(table: int, projection: int) -> float:
    """Where the cells of a projection begin, as a share of their width."""
    return int(hashlib.md5(f"shift:{table}:{projection}".encode()).hexdigest()[:4], 16) / 65536


def n_projections(n: int) -> int:
    """So many that the square root of ``n`` buckets can be told apart at about three cells each."""
    return max(1, math.ceil(math.log(max(n, 2), 9)))


def parameters(vecs: DataFrame, tables: int = TABLES) -> Params:
    """Projections by the number of vectors, the cells' width by their mean square, in one aggregate."""
    r = vecs.agg(F.count(F.lit(1)).alias("n"), F.avg(VF.dot("embedding", "embedding")).alias("sq"), F.max(F.size("embedding")).alias("dim")).first()
    width = WIDTH * math.sqrt(r["sq"] or 1.0)  # a projection is a sum of signed components, its variance the mean square
    return Params(tables, n_projections(r["n"]), r["dim"] or 1, round(width, 6))


def cells(x: np.ndarray, p: Params) -> np.ndarray:
    """Position of every row in units of cells, by (table, projection)."""
    a = np.array([[1.0 if c == "+" else -1.0 for c in signs(t, j, p.dim)] for t in range(p.tables) for j in range(p.projections)])
    u = np.array([shift(t, j) for t in range(p.tables) for j in range(p.projections)])
    return (x @ a.T / p.width + u).reshape(len(x), p.tables, p.projections)


def bucket_rows(vecs: DataFrame, p: Params, id_col: str = "vec_id") -> DataFrame:
    """(table_no, bucket, vec_id): each vector's bucket in every table, the cell numbers joined by commas."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, V.ROWS):
                part = batch.slice(at, V.ROWS)
                x = part["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(part.num_rows, -1)
                at_cells = np.floor(cells(x, p)).astype(np.int64)
                names = [",".join(map(str, c)) for c in at_cells.reshape(-1, p.projections).tolist()]
                tables = np.tile(np.arange(p.tables, dtype=np.int32), part.num_rows)
                ids = np.repeat(part["vec_id"].to_numpy(zero_copy_only=False), p.tables)
                yield pa.RecordBatch.from_arrays([pa.array(tables), pa.array(names), pa.array(ids)], ["table_no", "bucket", "vec_id"])

    rows = vecs.where(F.col("embedding").isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), "embedding")
    return rows.mapInArrow(run, "table_no int, bucket string, vec_id long")


def slot_of(table, bucket, slots: int = SLOTS):
    return F.pmod(F.xxhash64(table, bucket), F.lit(slots)).cast("int")


def part_of(id_col, slots: int = SLOTS):
    return F.pmod(F.xxhash64(id_col), F.lit(slots)).cast("int")


def build(vecs: DataFrame, path: str, id_col: str = "vec_id", tables: int = TABLES) -> Params:
    """Write the index of ``vecs`` (id, embedding) under ``path``. Null vectors are left out. A rebalance
    splits a bucket of many equal vectors over several files."""
    spark, p = vecs.sparkSession, parameters(vecs, tables)
    rows = bucket_rows(vecs, p, id_col).withColumn("slot", slot_of("table_no", "bucket"))
    rows.hint("rebalance", "slot").write.partitionBy("slot").parquet(f"{path}/buckets")
    sizes = read(spark, path, "buckets").groupBy("table_no", "bucket").agg(F.count(F.lit(1)).alias("n"))
    sizes.write.parquet(f"{path}/sizes")
    held = vecs.where(F.col("embedding").isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), "embedding")
    held.withColumn("part", part_of("vec_id")).hint("rebalance", "part").write.partitionBy("part").parquet(f"{path}/vectors")
    meta = [(p.tables, p.projections, p.dim, p.width)]
    spark.createDataFrame(meta, "tables int, projections int, dim int, width double").coalesce(1).write.parquet(f"{path}/meta")
    return p


SCHEMAS = {
    "buckets": "table_no int, bucket string, vec_id long, slot int",
    "sizes": "table_no int, bucket string, n long",
    "vectors": "vec_id long, embedding array<float>, part int",
    "meta": "tables int, projections int, dim int, width double",
}


def read(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{path}/{name}")


def probes(spark: SparkSession, path: str, queries: DataFrame, target: int) -> DataFrame:
    """(query_id, table_no, bucket, slot, n): the buckets that each query visits, nearest border first, until
    those before hold ``target`` vectors of their tables (a vector counts once per table).

    Queries meet the sizes in blocks. A task keeps, per query and batch of buckets, the nearest up to the
    target: what lies beyond them cannot be needed. The rest is one window per query over what was kept."""
    p = Params(*read(spark, path, "meta").first())
    kept = None
    for block in V.blocks(queries, "query_id"):
        shared = spark.sparkContext.broadcast((block[0], cells(block[1], p)))

        def near(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            ids, at = shared.value
            for batch in batches:
                held = []
                corner = np.array([c.split(",") for c in batch["bucket"].to_pylist()], np.float64).reshape(batch.num_rows, -1)
                tables = batch["table_no"].to_numpy(zero_copy_only=False)
                n = batch["n"].to_numpy(zero_copy_only=False)
                for i, q in enumerate(ids):
                    y = at[i][tables]
                    off = np.maximum(np.maximum(corner - y, y - corner - 1), 0.0)
                    d = (off * off).sum(axis=1)
                    order = np.lexsort((tables, d))
                    order = order[: int(np.searchsorted(np.cumsum(n[order]), target)) + 1]
                    held.append(
                        pa.table({"query_id": np.full(len(order), q), "table_no": tables[order], "bucket": batch["bucket"].take(order), "n": n[order], "d": d[order]})
                    )
                yield from pa.concat_tables(held).combine_chunks().to_batches()

        part = read(spark, path, "sizes").mapInArrow(near, "query_id long, table_no int, bucket string, n long, d double")
        kept = part if kept is None else kept.unionByName(part)
    if kept is None:
        return spark.createDataFrame([], "query_id long, table_no int, bucket string, n long, d double, slot int").drop("d")
    before = Window.partitionBy("query_id").orderBy("d", "table_no", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    taken = kept.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("_before") < target)
    return taken.select("query_id", "table_no", "bucket", slot_of("table_no", "bucket").alias("slot"), "n")


def search(spark: SparkSession, path: str, queries: DataFrame, k: int, target: int) -> DataFrame:
    """(query_id, rank, vec_id, dist): the k nearest by Euclidean distance among the vectors of the visited
    buckets, ties to the smaller id. Only the slots and parts that hold them are read."""
    visited = stored(probes(spark, path, queries, target), "probes")
    slots = [r[0] for r in visited.select("slot").distinct().collect()]  # at most SLOTS numbers
    hit = read(spark, path, "buckets").where(F.col("slot").isin(slots)).join(visited.drop("slot", "n"), ["table_no", "bucket"])
    candidates = hit.select("query_id", "vec_id").distinct().withColumn("part", part_of("vec_id"))
    q = queries.select("query_id", F.col("embedding").alias("qv"))
    met = candidates.join(read(spark, path, "vectors"), ["part", "vec_id"]).join(q, "query_id")
    scored = met.select("query_id", "vec_id", VF.l2_dist("embedding", "qv").alias("dist")).withColumn("_near", -F.col("dist"))
    return R.topk_batch(scored, "query_id", k, score="_near", id_col="vec_id", ties="asc").select("query_id", "rank", "vec_id", "dist")


def recall(spark: SparkSession, path: str, queries: DataFrame, k: int, target: int) -> DataFrame:
    """(query_id, recall): the share of each query's exact k nearest that the search finds."""
    exact = V.exact_l2(read(spark, path, "vectors"), queries, k)
    return V.recall(search(spark, path, queries, k, target), exact, ["query_id"])


def calibrate(spark: SparkSession, path: str, queries: DataFrame, k: int, goal: float = 0.95, sample: int = 64) -> int:
    """The smallest target, of doublings from 16 k up to all rows of all tables, whose mean recall over at
    most ``sample`` queries (those with the smallest hash of their id) reaches ``goal``."""
    few = stored(queries.orderBy(F.md5(F.col("query_id").cast("string"))).limit(sample), "sample")
    exact = stored(V.exact_l2(read(spark, path, "vectors"), few, k), "exact")
    everything = read(spark, path, "sizes").agg(F.sum("n")).first()[0] or 1
    target = 16 * k
    while target < everything:
        found = V.recall(search(spark, path, few, k, target), exact, ["query_id"])
        if (found.agg(F.avg("recall")).first()[0] or 0.0) >= goal:
            return target
        target *= 2
    return everything
