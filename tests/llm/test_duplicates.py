"""Near-duplicate documents and vectors and their components against brute force."""

from __future__ import annotations

import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_session import llm  # noqa: F401
from quarry.llm import graph
from quarry.llm import minhash as mh
from quarry.llm import multiindex as mi
from quarry.llm.common import written
from quarry.llm.graph import components


def union(n, links):
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in links:
        root[find(a)] = find(b)
    return [find(a) for a in range(n)]


def test_components(llm):
    rng = random.Random(0)
    edges = [(i, i + 1) for i in range(100, 140)]  # a long chain
    edges += [(7, 200 + i) for i in range(60)] + [(3, 3), (5, 6), (6, 5), (5, 6)]  # a hub, a loop, repeats
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    rows = edges + [(None, 1), (2, None)]
    got = {r.node: r.comp for r in components(llm.createDataFrame(rows, "a long, b long")).collect()}
    nodes = sorted({x for a, b in edges if a != b for x in (a, b)})
    at = {x: n for n, x in enumerate(nodes)}
    group = union(len(nodes), [(at[a], at[b]) for a, b in edges if a != b])
    want = {x: min(y for y in nodes if group[at[y]] == group[at[x]]) for x in nodes}
    assert got == want
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    sets = [shingle_set(t, k) for _, t in rows]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    group = union(len(rows), links)
    ids = {}
    for n, g in enumerate(group):
        ids.setdefault(g, []).append(rows[n][0])
    low = {g: min((i for i in v if i is not None), default=None) for g, v in ids.items()}
    return [len(s) for s in sets], [low[g] for g in group]


def corpus():
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(4000)}"
    rows = []
    for i in range(40):
        base = [word() for _ in range(rng.randrange(1, 90))]
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randrange(4)):
            t = list(base)
            for _ in range(rng.randrange(0, 4)):
                t[rng.randrange(len(t))] = word()
            rows.append((len(rows), "  ".join(t).upper() if i % 3 else "\n".join(t)))
    chain = [word() for _ in range(100)]  # neighbours alike, ends not
    for i in range(8):
        chain = [*chain[4:], *[word() for _ in range(4)]]
        rows.append((1000 - i, " ".join(chain)))
    rows += [(3000 + i, rows[0][1]) for i in range(60)]  # a large group of equal texts
    near = [word() for _ in range(120)]
    for i in range(50):  # a large group of near copies
        t = list(near)
        t[i] = word()
        rows.append((4000 + i, " ".join(t)))
    shared = [word() for _ in range(25)]  # a common passage that makes no duplicates
    rows += [(5000 + i, " ".join([*shared, *[word() for _ in range(25)]])) for i in range(40)]
    rows += [(9000, None), (9001, ""), (9002, " \n\t"), (9003, None), (9004, "two words"), (9005, "TWO  words"), (9006, "é É"), (9007, "É é")]
    rows += [(None, rows[5][1]), (None, "alone here now"), (None, "alone here now"), rows[9], rows[9], (9, "another text of the id nine")]
    rows += [(9100, "long " + " ".join(f"x{j}" for j in range(30_000)))]
    return rows


CLASH = "doc_id long, text string, comp long, node long, n int, bucket string, _row int, kept int"


def test_near_duplicates_equal_brute_force(llm):
    rows = corpus()
    table = llm.createDataFrame([(*r, 1, 2, 3, "b", 4, 5) for r in rows], CLASH).repartition(5)
    sizes, comp = brute(rows, 4)
    got = sorted(map(str, ((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in mh.near_duplicates(table, "doc_id", "text").collect())))
    want = [(i, n, c, i is not None and i == c) for (i, _), n, c in zip(rows, sizes, comp, strict=True)]
    assert got == sorted(map(str, want))

    p = mh.Params(words=5)
    sizes, comp = brute(rows, 5)
    out = mh.deduplicate(table, "doc_id", "text", p)
    assert out.columns == table.columns
    kept = out.collect()
    groups = {}
    for (i, t), n, c in zip(rows, sizes, comp, strict=True):
        key = ("null", t) if c is None else c
        if n:
            groups.setdefault(key, []).append((i is None, i if i is not None else 0, t))
    assert sorted((r.doc_id if r.doc_id is not None else -1) for r in kept if mh.shingles((r.text or "").encode(), 5, mh.Words()).size) == sorted(
        -1 if min(v)[0] else min(v)[1] for v in groups.values()
    )
    assert sorted(r.doc_id for r in kept if not (r.text or "").split()) == [9000, 9001, 9002, 9003]


def test_near_duplicates_of_nothing(llm):
    assert mh.near_duplicates(llm.createDataFrame([], CLASH), "doc_id", "text").count() == 0
    assert mh.deduplicate(llm.createDataFrame([(1, None, 1, 1, 1, "", 1, 1)], CLASH), "doc_id", "text").count() == 1


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 500), min_size=40, max_size=200), st.sets(st.integers(0, 500), min_size=40, max_size=200))
def test_circulant_signatures_estimate_jaccard(a, b):
    sig = [mh.signature(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1024) for s in (a, b)]
    assert abs((sig[0] == sig[1]).mean() - len(a & b) / len(a | b)) < 0.1


def brute_vectors(rows, cosine=0.9):
    good = [n for n, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {n: np.array(rows[n][1], float) / np.linalg.norm(np.array(rows[n][1], float)) for n in good}
    links = [(a, b) for a in good for b in good if b < a and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    group = union(len(rows), links)
    ids = {}
    for n, g in enumerate(group):
        ids.setdefault(g, []).append(rows[n][0])
    return [(i, c, min((x for x in ids[g] if x is not None), default=None)) for (i, _), c, g in zip(rows, count, group, strict=True)]


def test_vectors_equal_brute_force(llm):
    rng = np.random.default_rng(5)
    rows = []
    for _ in range(120):
        base = rng.normal(size=16)
        for _ in range(rng.integers(1, 6)):
            v = base + rng.normal(size=16) * rng.choice([0.05, 0.3, 0.5])
            rows.append((len(rows), [float(np.float32(x)) for x in v]))
    rows += [(5000 + i, rows[0][1]) for i in range(70)]  # equal vectors
    near = rng.normal(size=16)
    rows += [(6000 + i, [float(np.float32(x)) for x in near + rng.normal(size=16) * 0.05]) for i in range(90)]
    rows += [(7000, None), (7001, []), (7002, [0.0] * 16), (7003, [1.0, None] * 8), (7004, [float("nan")] * 16), (7005, [float("inf")] + [0.0] * 15)]
    rows += [(7006, [2 * x for x in rows[1][1]]), (7007, [1.0, 0.0]), (7008, [3.0, 0.0]), (None, rows[2][1]), rows[3], rows[3], (7009, [0.0, 5.0])]
    schema = "vec_id long, embedding array<float>, label int, node long, v int, comp string, same int, kept int"
    table = llm.createDataFrame([(*r, 1, 2, 3, "x", 4, 5) for r in rows], schema).repartition(4)
    want = brute_vectors(rows)
    # with the margin of the farthest neighbour made at the threshold, and every crowded cell split
    got = mi.near_duplicates(table, "vec_id", "embedding", mi.Params(target=1.0, members=16, probes=32)).collect()
    assert sorted(map(str, ((r.vec_id, r.n_links, r.component_id) for r in got))) == sorted(map(str, want))
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    # with the production margin: at least 0.9 of the links, and none too many
    got = mi.near_duplicates(table, "vec_id", "embedding").collect()
    most = {i: c for i, c, _ in want if i is not None}
    assert sum(r.n_links for r in got) >= 0.9 * sum(c for _, c, _ in want)
    assert all(r.n_links <= most[r.vec_id] for r in got if r.vec_id is not None)
    assert mi.near_duplicates(table.limit(0), "vec_id", "embedding").count() == 0
    assert [r.n_links for r in mi.near_duplicates(table.where("vec_id = 7002"), "vec_id", "embedding").collect()] == [0]


def test_multi_sequence_order():
    rng = np.random.default_rng(1)
    a, b = rng.random(9), rng.random(7)
    got = mi.traverse(a, b, 0.4)
    sums = (a[:, None] + b[None, :]).ravel()
    assert got == [int(c) for c in np.argsort(sums, kind="stable") if sums[c] <= sums.min() + 0.4]


def test_a_small_graph_is_one_chunk(llm, monkeypatch):
    """op9: a chain over many tasks takes two written tables, not rounds of five; the rounds of a graph of
    more than CHUNK edges end in the same components."""
    names = []
    monkeypatch.setattr(graph, "written", lambda df, name: names.append(name) or written(df, name))
    n = 300
    edges = llm.createDataFrame([((i * 7) % n, (i * 7 + 7) % n) for i in range(n - 1)], "a long, b long").repartition(16)
    want = [(i, 0) for i in range(n)]
    assert sorted(map(tuple, graph.components(edges).collect())) == want
    assert len(names) == 2
    for chunk in (1, 50):
        monkeypatch.setattr(graph, "CHUNK", chunk)
        assert sorted(map(tuple, graph.components(edges).collect())) == want
