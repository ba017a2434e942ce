"""Near-duplicate vectors through an inverted multi-index with multi-sequence traversal."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import numbered, written
from quarry.llm.graph import components


@dataclass(frozen=True)
class Params:
    """cosine: links are at this cosine or above. The codebooks are fitted on at most ``fit_rows``
    vectors (those with the smallest hashes); each half has about sqrt(vectors / per_cell) centroids,
    at most ``max_codes``. target: share of neighbours made at exactly the threshold whose cell the
    traversal must reach from one side or the other. members, probes: most vectors of a cell that
    one task compares at a time."""

    cosine: float = 0.9
    fit_rows: int = 20_000
    per_cell: int = 8
    max_codes: int = 512
    target: float = 0.98
    members: int = 1024
    probes: int = 4096


@dataclass
class Codebooks:
    left: np.ndarray
    right: np.ndarray
    margin: float

    def distances(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = self.left.shape[1]
        return _squared(u[:, :h], self.left), _squared(u[:, h:], self.right)


def _squared(a: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (a * a).sum(1)[:, None] - 2 * a @ c.T + (c * c).sum(1))


def unit(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column scaled to length 1 in double precision, padded with zeros to ``dim``."""
    out = np.zeros((len(column), dim))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(sizes) and (sizes == dim).all():
        out[:] = flat.reshape(len(sizes), dim)
    else:
        out[np.arange(dim)[None, :] < sizes[:, None]] = flat
    out /= np.maximum(np.abs(out).max(axis=1, initial=0.0), 1e-300)[:, None]
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def codebooks(u: np.ndarray, k: int, p: Params) -> Codebooks:
    """k-means of either half of the sample, and the margin beyond a query's own cell that the
    traversal covers. For neighbours made at exactly the threshold cosine in random directions, the
    margin at which one finds the other's cell has the target as its share."""
    rng = np.random.default_rng(11)
    half = (u.shape[1] + 1) // 2

    def means(a: np.ndarray) -> np.ndarray:
        c = a[rng.choice(len(a), min(k, len(a)), replace=False)].copy()
        for _ in range(10):
            near = _squared(a, c).argmin(axis=1)
            n = np.bincount(near, minlength=len(c))
            sums = np.stack([np.bincount(near, a[:, j], minlength=len(c)) for j in range(a.shape[1])], axis=1)
            c[n > 0] = sums[n > 0] / n[n > 0, None]
        return c

    right = u[:, half:] if u.shape[1] > 1 else np.zeros((len(u), 1))
    books = Codebooks(means(u[:, :half]), means(right), 0.0)
    x = u[rng.choice(len(u), min(4000, len(u)), replace=False)]
    away = rng.normal(size=x.shape)
    away -= (away * x).sum(1)[:, None] * x
    away /= np.maximum(np.sqrt((away * away).sum(1)), 1e-300)[:, None]
    y = p.cosine * x + np.sqrt(1 - p.cosine**2) * away
    (x1, x2), (y1, y2), row = books.distances(x), books.distances(y), np.arange(len(x))
    there = x1[row, y1.argmin(1)] + x2[row, y2.argmin(1)] - x1.min(1) - x2.min(1)
    back = y1[row, x1.argmin(1)] + y2[row, x2.argmin(1)] - y1.min(1) - y2.min(1)
    books.margin = float(np.quantile(np.minimum(there, back), p.target))
    return books


def traverse(d1: np.ndarray, d2: np.ndarray, margin: float) -> list[int]:
    """Cells (i * len(d2) + j) by growing d1[i] + d2[j], from the nearest up to ``margin`` beyond it:
    the multi-sequence algorithm over the two sorted lists."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    s1, s2 = d1[o1].tolist(), d2[o2].tolist()
    limit = s1[0] + s2[0] + margin
    heap, done, out = [(s1[0] + s2[0], 0, 0)], set(), []
    while heap:
        s, i, j = heapq.heappop(heap)
        if s > limit:
            break
        done.add((i, j))
        out.append(int(o1[i]) * len(s2) + int(o2[j]))
        if i + 1 < len(s1) and (j == 0 or (i + 1, j - 1) in done):
            heapq.heappush(heap, (s1[i + 1] + s2[j], i + 1, j))
        if j + 1 < len(s2) and (i == 0 or (i - 1, j + 1) in done):
            heapq.heappush(heap, (s1[i] + s2[j + 1], i, j + 1))
    return out


def _encoder(shared, dim: int):
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        books = shared.value
        for column in batches:
            d1, d2 = books.distances(unit(column, dim))
            cells = [traverse(a, b, books.margin) for a, b in zip(d1, d2, strict=True)]
            at = np.concatenate([[0], np.cumsum([len(c) for c in cells])])
            yield pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array([c for v in cells for c in v], pa.int32()))

    return F.arrow_udf(encode, "array<int>")


def _compare(dim: int, p: Params):
    """Links between the members and the probes of one block of a cell: per vector with links its
    smallest partner through this block's links and the number of copies linked. A pair that both
    sides reach is counted where the probe has the smaller node."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        probe = table["probe"].to_numpy()
        node, copies, size, cell = (table[c].to_numpy() for c in ("node", "copies", "size", "home"))
        u = unit(table["v"].chunk(0), dim)
        a, b = np.flatnonzero(probe), np.flatnonzero(~probe)
        s = u[a] @ u[b].T
        i, j = np.nonzero(s >= p.cosine - 1e-9)
        i, j = a[i], b[j]
        exact = np.array([float(np.dot(u[x], u[y])) for x, y in zip(i, j, strict=True)]) if len(i) < 1000 else (u[i] * u[j]).sum(axis=1)
        ok = (exact >= p.cosine) & (size[i] == size[j]) & (node[i] != node[j])
        i, j = i[ok], j[ok]
        visits = table["visits"].chunk(0)
        at, cells = visits.offsets.to_numpy(), visits.values.to_numpy()
        seen = {x: set(cells[at[x] : at[x + 1]].tolist()) for x in set(j.tolist())}
        mutual = np.array([c in seen[y] for c, y in zip(cell[i].tolist(), j.tolist(), strict=True)], bool)
        ok = ~mutual | (node[i] < node[j])
        i, j = i[ok], j[ok]
        ids, where = np.unique(np.concatenate([node[i], node[j]]), return_inverse=True)
        x, y = where[: len(i)], where[len(i) :]
        add = np.bincount(x, copies[j], minlength=len(ids)) + np.bincount(y, copies[i], minlength=len(ids))
        root = np.arange(len(ids))
        while True:
            low = root.copy()
            np.minimum.at(low, x, root[y])
            np.minimum.at(low, y, root[x])
            low = low[low]
            if (low == root).all():
                break
            root = low
        return pa.table({"node": ids, "root": ids[root] if len(ids) else ids, "add": add.astype(np.int64)})

    return run


def near_duplicates(vectors: DataFrame, id_col: str, vec_col: str, p: Params = Params()) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors of equal length and a cosine of at least the threshold are linked. Null, empty and zero
    vectors and those with null, NaN or infinite components are linked with nothing. Equal vectors
    are one node that stands for all its rows (n_links counts the rows). Rows that repeat an id are
    rows of their own; null ids are never the smallest, and a component of null ids keeps none.

    Every node lies in the cell of its nearest centroids and visits the cells its traversal reaches.
    A cell's members and visitors are split into blocks by hash, so a crowded cell is many tasks,
    and a block returns counts and local components instead of its pairs.
    """
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) | ~F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(v.isNotNull() & ~bad, v)).withColumn("same", F.unhex(F.md5(v.cast("string"))))
    rows = numbered(rows, "vectors")
    full = rows.where(v.isNotNull())
    nodes = full.groupBy("same").agg(F.min("_row").alias("node"), F.count(F.lit(1)).alias("copies"))
    reps = full.join(nodes.select(F.col("node").alias("_row"), "copies"), "_row").select(F.col("_row").alias("node"), "v", "copies")
    reps = written(reps, "vector-nodes")
    n, dim = reps.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if n:
        links, edges = _links(reps, n, dim, p)
        comp = components(edges, "vector-components")
    else:
        links = reps.select("node", F.lit(0).cast("long").alias("links"))
        comp = reps.select("node", F.col("node").alias("comp"))
    known = nodes.join(links, "node", "left").join(comp, "node", "left")
    known = known.select(
        F.col("same").alias("_s"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("comp", "node").alias("comp"),
    )
    tagged = rows.join(known, F.col("same") == F.col("_s"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("comp", "_row").alias("comp")
    )
    smallest = written(tagged.groupBy("comp").agg(F.min("vec_id").alias("component_id")), "smallest")
    out = tagged.join(smallest, "comp")
    return out.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _links(reps: DataFrame, n: int, dim: int, p: Params) -> tuple[DataFrame, DataFrame]:
    """(node, links) and (a, b) over the nodes."""
    h = F.xxhash64("v")
    edge = reps.select(h.alias("h")).orderBy("h").limit(p.fit_rows).agg(F.max("h")).first()[0]
    sample = reps.where(h <= edge).orderBy(h, "node").select("v").toArrow()["v"].combine_chunks()  # at most fit_rows
    sample = sample.chunk(0) if isinstance(sample, pa.ChunkedArray) else sample
    k = int(np.clip(np.sqrt(n / p.per_cell), 4, p.max_codes))
    books = codebooks(unit(sample, max(dim, 2)), k, p)
    width = max(dim, 2)
    shared = reps.sparkSession.sparkContext.broadcast(books)  # 2 x max_codes x dim / 2 doubles
    coded = written(reps.withColumn("visits", _encoder(shared, width)("v")), "coded-vectors")
    cell = F.col("visits")[0]
    members = coded.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("m"))
    probes = coded.select(F.explode("visits").alias("cell")).groupBy("cell").agg(F.count(F.lit(1)).alias("q"))
    parts = members.join(probes, "cell").where("m > 1 OR q > 1")
    parts = parts.select(
        F.col("cell").alias("c"), F.ceil(F.col("m") / p.members).cast("int").alias("mp"), F.ceil(F.col("q") / p.probes).cast("int").alias("qp")
    )
    cols = ["node", "v", "copies", F.size("v").alias("size"), cell.alias("home")]
    spread = F.pmod(F.xxhash64("node"), F.lit(1 << 30)).cast("int")
    none = F.array().cast("array<int>")
    m = coded.select(*cols, "visits", cell.alias("cell"), F.lit(False).alias("probe"))
    m = m.join(parts, F.col("cell") == F.col("c")).withColumn("mpart", spread % F.col("mp"))
    m = m.withColumn("qpart", F.explode(F.sequence(F.lit(0), F.col("qp") - 1)))
    q = coded.select(*cols, none.alias("visits"), F.explode("visits").alias("cell"), F.lit(True).alias("probe"))
    q = q.join(parts, F.col("cell") == F.col("c")).withColumn("qpart", spread % F.col("qp"))
    q = q.withColumn("mpart", F.explode(F.sequence(F.lit(0), F.col("mp") - 1)))
    order = ["cell", "mpart", "qpart", "probe", "node", "v", "copies", "size", "home", "visits"]
    blocks = m.select(order).union(q.select(order)).groupBy("cell", "mpart", "qpart")
    found = written(blocks.applyInArrow(_compare(width, p), "node long, root long, add long"), "vector-links")
    return found.groupBy("node").agg(F.sum("add").alias("links")), found.select(F.col("node").alias("a"), F.col("root").alias("b"))
