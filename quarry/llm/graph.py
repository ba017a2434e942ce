"""Connected components of an edge table by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_written, written

CHUNK = 1 << 18  # edges that a task contracts at a time; a graph of no more is finished as one chunk


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (a > b) that connect what ``edges`` (a, b) connect: within a task, every chunk of edges becomes
    stars around the smallest node of each of its components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root[top]) != top:
                top = up
            while root[x] != top:
                root[x], x = top, root[x]
            return top

        def stars() -> pa.RecordBatch:
            found = [(x, find(x)) for x in root]
            found = [(x, r) for x, r in found if x != r]
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["a", "b"])

        held = 0
        for batch in batches:
            for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist(), strict=True):
                x, y = find(root.setdefault(a, a)), find(root.setdefault(b, b))
                if x != y:
                    root[max(x, y)] = min(x, y)
            held += batch.num_rows
            if held >= CHUNK:
                yield stars()
                root, held = {}, 0
        yield stars()

    return edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "a long, b long")


def _few(edges: DataFrame) -> bool:
    """Whether one chunk holds all of the edges."""
    return edges.count() <= CHUNK


def _stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (a > b) is either a centre or has one edge, to a centre."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("out")).union(edges.select("b", F.lit(0)))
    mixed = ends.groupBy("node").agg(F.sum("out").alias("o"), F.min("out").alias("lo")).where("o > 1 OR (o = 1 AND lo = 0)")
    return mixed.isEmpty()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) for every node of ``edges`` (columns a, b); comp is the smallest node id
    reachable. Self loops, repeated and reversed edges and an empty table are fine; null ends are
    dropped.

    Edges are contracted to stars within each task, before and after the exchange that drops repeated ones,
    which leaves little to do where a task holds most of a component. Each round then links every node's larger neighbours to its smallest neighbour,
    then every node's smaller neighbours likewise, until only stars are left; it needs O(log^2) rounds
    whatever the diameter. Minima are partial aggregates, and the hub's edges meet one row in the joins;
    the minima are written first, so that a join reads plain shuffles, of which AQE splits the hub's.
    Every round is a written table. As soon as at most CHUNK edges are left, before the first round or after
    any, one chunk holds them all, and its stars are the components.
    """
    a, b = F.col("a"), F.col("b")
    some = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    cur = written(contracted(some), name)
    if not _few(cur):
        first, cur = cur, written(contracted(cur.distinct()), name)
        drop_written(first)
    while not (few := _few(cur)) and not _stars(cur):
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = written(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), name)
        large = both.where(F.col("b") > F.col("a")).join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # every node also keeps an edge to its own minimum when that is smaller than itself
        large = large.union(low.where(F.col("m") < F.col("a")).select("a", F.col("m").alias("b")))
        large = written(contracted(large).distinct(), name)
        low2 = written(large.groupBy("a").agg(F.min("b").alias("m")), name)
        small = large.join(low2, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.union(low2.select("a", F.col("m").alias("b")))
        nxt = written(contracted(contracted(small).distinct()), name)
        for done in (cur, low, large, low2):
            drop_written(done)
        cur = nxt
    if few:
        last, cur = cur, written(contracted(cur.coalesce(1)), name)
        drop_written(last)
    roots = cur.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return cur.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(roots)
