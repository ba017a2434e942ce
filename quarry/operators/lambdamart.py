"""LambdaMART: boosted regression trees on the gradient of nDCG@k, over one table of binned rows.

A round's gradients come from pairs of a query's documents of different gain, each weighted by how much
swapping the two would change nDCG@k. Only pairs with at least one document among the query's best k
can change it, so every row meets the (at most k) best rows of its query and nothing else: k * n pairs in
numpy, none of them a row of its own. A query's best k, and what the other rows add to their
gradients, are sums that the tasks make over their rows, so a query with a third of all rows is never in one task.

Trees are grown level by level from histograms (node, feature, bin) of first and second derivatives;
features are cut into bins once, by quantiles of the training rows. A leaf's value is -G / (H + l2).
Sums are of whole billionths, so the trees do not depend on how rows are dealt over tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import scoring as S
from quarry.operators import rank as R
from quarry.operators.util import discard, stored

NONE = -1  # feature of a node that is not split
KEPT = 20  # trees that the tasks add to the stored scores before these are written anew


@dataclass
class Tree:
    """A full binary tree: node i has the children 2 i + 1 (feature <= threshold) and 2 i + 2."""

    features: list[int]
    thresholds: list[float]
    values: list[float]  # of the leaves, left to right
    gains: list[float]


@dataclass
class Model:
    columns: list[str]
    depth: int
    rate: float
    trees: list[Tree]
    history: list[tuple[int, float | None, float | None]] = field(default_factory=list)

    @property
    def best_round(self) -> int:
        """The number of trees with the best validation nDCG (the fewest, of equals)."""
        return max(((v, -r) for r, _, v in self.history if v is not None), default=(0, -len(self.trees)))[1] * -1

    def upto(self, rounds: int) -> Model:
        return Model(self.columns, self.depth, self.rate, self.trees[:rounds], self.history[: rounds + 1])

    def importance(self, k: int = 10) -> list[tuple[str, float]]:
        """The k most important features: mean gain of their splits, as shares (ties: later name first)."""
        total: dict[str, list[float]] = {c: [] for c in self.columns}
        for t in self.trees:
            for f, g in zip(t.features, t.gains, strict=True):
                if f != NONE:
                    total[self.columns[f]].append(g)
        mean = {c: sum(g) / len(g) if g else 0.0 for c, g in total.items()}
        whole = sum(mean.values()) or 1.0
        return [(c, v / whole) for v, c in sorted(((v, c) for c, v in mean.items()), reverse=True)[:k]]


def inputs(df: DataFrame, columns: list[str]) -> Column:
    """The feature array; nulls are 0."""
    return F.array(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns])


def cut_points(df: DataFrame, columns: list[str], bins: int) -> list[list[float]]:
    """Per feature, at most ``bins`` - 1 ascending quantiles, one sketch pass for all features."""
    filled = df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(columns)])
    shares = [i / bins for i in range(bins)]
    found = filled.approxQuantile([f"c{i}" for i in range(len(columns))], shares, 1.0 / (4 * bins))
    return [sorted(set(q)) for q in found]


def binned(x: Column, cuts: list[list[float]]) -> Column:
    """Bin number of every feature: how many cut points lie below its value."""
    points = F.array(*[F.array(*[F.lit(c) for c in q]) if q else F.array().cast("array<double>") for q in cuts])
    return F.transform(x, lambda v, i: F.aggregate(F.get(points, i), F.lit(0), lambda n, c: n + (c < v).cast("int")))


def _descend(x: str, features: str, thresholds: str, depth: int) -> str:
    """Number of the leaf (0 .. 2^depth - 1) that a row with the values ``x`` reaches, as SQL text."""
    step = f"2 * n + IF(get({x}, get({features}, n)) > get({thresholds}, n), 2, 1)"
    return f"(aggregate(array({', '.join(map(str, range(depth)))}), 0, (n, i) -> {step}) - {(1 << depth) - 1})"


def gain_and_ideal(judged: DataFrame, k: int) -> DataFrame:
    """Rows with ``gain`` and the query's ideal DCG@k (``idcg``), from the counts of each gain."""
    rows = judged.withColumn("gain", S.label_gain("label").cast("double"))
    counts = rows.groupBy("query_id").agg(
        *[F.count(F.when(F.col("gain") == g, 1)).alias(f"_n{g}") for g in sorted(set(S.LABEL_GAIN.values()))]
    )
    # DCG of n documents of one gain after m better ones: differences of the discounts' running sums
    sums = F.array(*[F.lit(sum(1 / math.log2(i + 2) for i in range(n))) for n in range(k + 1)])
    ideal, before = F.lit(0.0), F.lit(0)
    for g in sorted(set(S.LABEL_GAIN.values()), reverse=True):
        after = before + F.col(f"_n{g}")
        upto = lambda n: F.get(sums, F.least(n, F.lit(k)).cast("int"))
        ideal = ideal + F.lit(float(g)) * (upto(after) - upto(before))
        before = after
    return rows.join(counts.select("query_id", ideal.alias("idcg")), "query_id")


def _half_up(x: np.ndarray) -> np.ndarray:
    return (np.sign(x) * np.floor(np.abs(x) + 0.5)).astype(np.int64)


@dataclass
class Best:
    """The best k rows of every query, a line per query (ascending ids) and a column per rank. This is what a
    round holds outside of the tasks: k rows per query, however many rows the queries have."""

    query: np.ndarray
    n: np.ndarray  # rows in the line, at most k
    doc: np.ndarray
    s: np.ndarray
    gain: np.ndarray
    idcg: np.ndarray
    fit: np.ndarray
    back_g: np.ndarray  # what the rows beyond the best give each of them
    back_h: np.ndarray
    firsts: np.ndarray  # rows of rank 1

    def ndcg(self) -> np.ndarray:
        dcg = np.zeros(len(self.query))
        for i in range(self.doc.shape[1]):
            dcg += np.where(i < self.n, self.gain[:, i] / np.log2(i + 2), 0.0)
        return np.divide(dcg, self.idcg, out=np.full(len(dcg), np.nan), where=self.idcg > 0)

    def pairs(self, query, doc, gain, idcg, s):
        """Rows' lines, their ranks among the best (0: beyond) and the g and h that the pair with each of the best
        gives them: below its place if the row's gain is less, else above it."""
        line, k = np.searchsorted(self.query, query), self.doc.shape[1]
        held = np.arange(k) < self.n[line][:, None]
        same = (self.doc[line] == doc[:, None]) & held
        rank = np.where(same.any(axis=1), same.argmax(axis=1) + 1, 0)
        discount = 1 / np.log2(np.arange(k) + 2)
        own = np.where(rank > 0, discount[rank - 1], 0.0)[:, None]
        their, more = self.gain[line], gain[:, None] > self.gain[line]
        some = (gain[:, None] != their) & held & (idcg[:, None] > 0)
        weight = np.abs(gain[:, None] - their) * np.abs(own - discount) / np.where(idcg > 0, idcg, 1.0)[:, None]
        ahead = np.where(some, np.where(more, s[:, None] - self.s[line], self.s[line] - s[:, None]), 0.0)
        with np.errstate(over="ignore"):
            rho = 1 / (1 + np.exp(ahead))
        g = np.where(some, np.where(more, -1, 1) * rho * weight * R.UNITS, 0.0)
        return line, rank, _half_up(g), _half_up(np.where(some, rho * (1 - rho) * weight * R.UNITS, 0.0))

    def gradients(self, *row):
        """Lines, ranks and the rows' whole g and h."""
        line, rank, g, h = self.pairs(*row)
        g, h = g.sum(axis=1), h.sum(axis=1)
        top = rank > 0
        g[top] -= self.back_g[line[top], rank[top] - 1]
        h[top] += self.back_h[line[top], rank[top] - 1]
        return line, rank, g, h


def _leading(parts: tuple, k: int) -> tuple:
    """Of rows (query, doc, s, ...), each query's best k in order of query and rank, ties to the smaller doc."""
    query, doc, s = parts[:3]
    order = np.lexsort((doc, -s, query))
    ids = query[order]
    start = np.searchsorted(ids, ids, side="left")
    order = order[np.arange(len(ids)) - start < k]
    return tuple(x[order] for x in parts)


ROW = "query_id", "doc_id", "gain", "idcg", "s"
BEST_SCHEMA = "query_id long, doc_id long, s double, gain double, idcg double, fit boolean"


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _current(batch: pa.RecordBatch, trees: list, rate: float, depth: int) -> tuple:
    """A batch's (query, doc, gain, idcg, s): the stored scores and the trees grown since."""
    *row, s = (_column(batch, c) for c in ROW)
    if trees and batch.num_rows:
        s, bins = s.copy(), _bins(batch)
        for features, places, values in trees:
            s += rate * values[_place(bins, features, places, depth)]
    return *row, s


def _bins(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint16).reshape(batch.num_rows, -1)


def _place(bins: np.ndarray, features: np.ndarray, places: np.ndarray, depth: int) -> np.ndarray:
    """Node of the level below ``depth`` splits that the rows reach, left to right."""
    node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        f = features[node]
        node = 2 * node + 1 + ((f != NONE) & (bins[rows, f] > places[node]))
    return node - ((1 << depth) - 1)


def best_of(rows: DataFrame, k: int, trees=(), rate: float = 0.0, depth: int = 0) -> Best:
    """The best k of every query of ``rows`` (query_id, doc_id, gain, idcg, s, fit, bins): two jobs without an
    exchange, tasks keep k rows per query. The second sums what the rows beyond give the best."""
    trees = list(trees)

    def lead(batches):
        held = None
        for batch in batches:
            query, doc, gain, idcg, s = _current(batch, trees, rate, depth)
            new = (query, doc, s, gain, idcg, _column(batch, "fit").astype(bool))
            held = _leading(new if held is None else tuple(np.concatenate(x) for x in zip(held, new, strict=True)), k)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], ["query_id", "doc_id", "s", "gain", "idcg", "fit"])

    found = rows.mapInArrow(lead, BEST_SCHEMA).toArrow().combine_chunks()
    query, doc, s, gain, idcg, fit = _leading(tuple(found.column(c).to_numpy() for c in found.column_names), k)
    ids, start, n = np.unique(query, return_index=True, return_counts=True)
    line = np.repeat(np.arange(len(ids)), n)
    rank = np.arange(len(query)) - start[line]

    def table(x):
        out = np.zeros((len(ids), k), x.dtype)
        out[line, rank] = x
        return out

    ideal = np.maximum.reduceat(idcg, start) if len(ids) else idcg
    nothing = np.zeros((len(ids), k), np.int64)
    best = Best(ids, n, table(doc), table(s), table(gain), ideal, fit[start], nothing, nothing, nothing[:, 0])

    def beyond(batches):
        sums, firsts = np.zeros((2, len(ids), k), np.int64), np.zeros(len(ids), np.int64)
        for batch in batches:
            line, rank, g, h = best.pairs(*_current(batch, trees, rate, depth))
            for into, x in zip(sums, (g, h), strict=True):
                np.add.at(into, line[rank == 0], x[rank == 0])
            np.add.at(firsts, line[rank == 1], 1)
        at, = np.nonzero(sums.any(axis=(0, 2)) | (firsts > 0))
        yield pa.RecordBatch.from_pydict(
            {"line": at, "firsts": firsts[at], "sums": [x.tobytes() for x in sums.transpose(1, 0, 2)[at]]},
            pa.schema([("line", pa.int64()), ("firsts", pa.int64()), ("sums", pa.binary())]),
        )

    back, firsts = np.zeros((len(ids), 2, k), np.int64), np.zeros(len(ids), np.int64)
    for r in rows.mapInArrow(beyond, "line long, firsts long, sums binary").collect():
        firsts[r["line"]] += r["firsts"]
        back[r["line"]] += np.frombuffer(bytes(r["sums"]), np.int64).reshape(2, k)
    best.back_g, best.back_h, best.firsts = back[:, 0], back[:, 1], firsts
    return best


def lambdas(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (query_id, doc_id, gain, idcg, s, ...) with g and h, the first and second derivative in whole
    billionths, the rank ``r`` among the query's best k (null beyond them) and the query's ``ndcg``.

    A pair's weight is |gain difference| * |discount difference| / idcg. Rows see the best k as arrays.
    Each sums its own pairs; the best k also get, by position, what the rows beyond them give."""
    rows = rows.withColumns({"gain": F.col("gain").cast("double"), "s": F.col("s").cast("double")})
    best = best_of(rows.select(*ROW, F.lit(True).alias("fit")), k)
    ndcg = best.ndcg()
    schema = T.StructType([*rows.schema, *T._parse_datatype_string("r int, ndcg double, g long, h long")])

    def run(batches):
        for batch in batches:
            line, rank, g, h = best.gradients(*(_column(batch, c) for c in ROW))
            gone = np.isnan(ndcg[line])
            more = [pa.array(rank, pa.int32(), mask=rank == 0), pa.array(ndcg[line], pa.float64(), mask=gone), pa.array(g), pa.array(h)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)

    return rows.mapInArrow(run, schema)


def histogram(rows: DataFrame, best: Best, trees, rate: float, depth: int, features, places, level: int, shape) -> np.ndarray:
    """Sums of g and h by (node of the level, feature, bin) over the rows with ``fit``, in whole billionths:
    one job without an exchange, from each task one table of this size."""
    trees, cells = list(trees), math.prod(shape)
    features, places = np.array(features, np.int64), np.array(places, np.int64)

    def run(batches):
        out = np.zeros((2, cells), np.int64)
        for batch in batches:
            batch = batch.filter(batch.column("fit"))
            if not batch.num_rows:
                continue
            bins = _bins(batch)
            _, _, g, h = best.gradients(*_current(batch, trees, rate, depth))
            node = _place(bins, features, places, level)
            cell = ((node[:, None] * shape[1] + np.arange(shape[1])) * shape[2] + bins).ravel()
            for into, x in zip(out, (g, h), strict=True):
                # bincount adds doubles: low and high parts keep the sums whole
                for part, times in ((x & 0xFFFFF, 1), (x >> 20, 1 << 20)):
                    into += np.bincount(cell, np.repeat(part, shape[1]), cells).astype(np.int64) * times
        yield pa.RecordBatch.from_pydict({"sums": [out.tobytes()]}, pa.schema([("sums", pa.binary())]))

    total = np.zeros((2, cells), np.int64)
    for r in rows.mapInArrow(run, "sums binary").collect():
        total += np.frombuffer(bytes(r["sums"]), np.int64).reshape(2, cells)
    return np.moveaxis(total.reshape(2, *shape), 0, -1)


def grow(sums, cuts: list[list[float]], depth: int, l2: float, least: float) -> tuple[Tree, list[int]]:
    """One tree, and its thresholds as bin numbers, from ``sums`` (features, places, level, shape -> histogram).
    A level has at most 2^depth * features * bins sums, which the driver searches for the best splits (of equal
    gain, the first feature and the lowest threshold)."""
    features, places = [NONE] * ((1 << depth) - 1), [0] * ((1 << depth) - 1)
    gains, n_bins = [0.0] * len(features), max(len(c) for c in cuts) + 1
    leaves: dict[int, tuple[float, float]] = {}
    for level in range(depth):
        first = (1 << level) - 1
        table = sums(features, places, level, (1 << level, len(cuts), n_bins)) / R.UNITS
        for n in range(1 << level):
            total = table[n, 0].sum(axis=0)
            left = table[n].cumsum(axis=1)[:, :-1]  # by feature and threshold
            right = total - left
            g, h = left[..., 0], left[..., 1]
            gain = g * g / (h + l2) + right[..., 0] ** 2 / (right[..., 1] + l2) - total[0] ** 2 / (total[1] + l2)
            gain[(h < least) | (right[..., 1] < least)] = 0.0
            f, b = np.unravel_index(np.argmax(np.round(gain, 9)), gain.shape)
            at, split = first + n, gain[f, b] > 1e-9
            if split:
                features[at], places[at], gains[at] = int(f), int(b), float(gain[f, b])
            if level == depth - 1:  # the next level's nodes are the leaves
                leaves[2 * n] = tuple(left[f, b]) if split else tuple(total)
                leaves[2 * n + 1] = tuple(right[f, b]) if split else (0.0, 0.0)
    values = [float(-leaves[i][0] / (leaves[i][1] + l2)) for i in range(1 << depth)]
    thresholds = [cuts[f][b] if f != NONE else 0.0 for f, b in zip(features, places, strict=True)]
    return Tree(features, thresholds, values, gains), places


def fit(
    train: DataFrame,
    columns: list[str],
    rounds: int = 100,
    rate: float = 0.3,
    depth: int = 4,
    k: int = 10,
    bins: int = 64,
    l2: float = 0.1,
    least: float = 1e-3,
    valid: DataFrame | None = None,
) -> Model:
    """``rounds`` trees on pairs (query_id, doc_id, label, ``columns``). With ``valid`` (other queries, same
    columns) the model's history has each round's mean nDCG@k of both; round 0 is no tree, all scores equal.
    The trees never see ``valid``.

    The binned rows are written once (the shared checkpoint folder). A round reads them in ``depth`` + 2 jobs
    without an exchange: the best k of every query, what the others give these, and a histogram per level. Scores
    are the stored ones and the trees grown since; they are written anew after every ``KEPT`` trees.
    Queries without a gain have no gradient and
    no nDCG. A (query_id, doc_id) pair is one row. The depth, ``bins`` and k rows per query bound what the
    driver holds."""
    cuts = cut_points(train, columns, bins)
    keep = ["query_id", "doc_id", "label", *columns]
    judged = train.select(*keep, F.lit(True).alias("fit"))
    if valid is not None:
        judged = judged.unionByName(valid.select(*keep, F.lit(False).alias("fit")))
    base = gain_and_ideal(judged, k)
    x = inputs(base, columns)
    data = base.select("query_id", "doc_id", "gain", "idcg", "fit", binned(x, cuts).alias("bins"), F.lit(0.0).alias("s"))
    data = data.repartitionByRange(base.sparkSession.sparkContext.defaultParallelism, "query_id", "doc_id")
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == "bins" else f.dataType) for f in data.schema])
    names = schema.names

    def packed(batches):
        for batch in batches:
            bins = [np.array(b, np.uint16).tobytes() for b in batch.column("bins").to_pylist()]
            columns = [pa.array(bins, pa.binary()) if c == "bins" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    def advanced(trees):
        def run(batches):
            for batch in batches:
                s = pa.array(_current(batch, trees, rate, depth)[-1])
                yield pa.RecordBatch.from_arrays([s if c == "s" else batch.column(c) for c in names], names)

        return run

    held = stored(data.mapInArrow(packed, schema), "lambdas")
    model = Model(list(columns), depth, rate, [])
    since: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def monitor(best: Best) -> None:
        ndcg, means = best.ndcg(), {}
        for part in (True, False):
            some = (best.fit == part) & ~np.isnan(ndcg)
            means[part] = float(np.average(ndcg[some], weights=best.firsts[some])) if some.any() else None
        model.history.append((len(model.trees), means[True], means[False]))

    for _ in range(rounds):
        best = best_of(held, k, since, rate, depth)
        if valid is not None:
            monitor(best)
        sums = partial(histogram, held, best, since, rate, depth)
        tree, places = grow(sums, cuts, depth, l2, least)
        model.trees.append(tree)
        since.append((np.array(tree.features), np.array(places), np.array(tree.values)))
        if len(since) == KEPT:
            last, held = held, stored(held.mapInArrow(advanced(list(since)), schema), "lambdas")
            discard(last)
            since.clear()
    if valid is not None:
        monitor(best_of(held, k, since, rate, depth))
    discard(held)
    return model


def score(model: Model, rows: DataFrame) -> DataFrame:
    """``rows`` with ``score``, the rate times the sum of the trees' values, in the row: the trees are one
    row of arrays that meets every row."""
    spark = rows.sparkSession
    trees = [(t.features, t.thresholds, t.values) for t in model.trees]
    kind = "trees array<struct<f: array<int>, t: array<double>, v: array<double>>>"
    one = F.broadcast(spark.createDataFrame([(trees,)], kind).withColumnRenamed("trees", "_trees"))
    met = rows.withColumn("_x", inputs(rows, model.columns)).crossJoin(one)
    value = f"aggregate(_trees, 0D, (a, e) -> a + {model.rate!r}D * get(e.v, {_descend('_x', 'e.f', 'e.t', model.depth)}))"
    return met.withColumn("score", F.expr(value)).drop("_x", "_trees")
