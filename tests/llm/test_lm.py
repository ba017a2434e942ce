"""The recurrent network's gradients and distribution, and the scoring query against brute force."""

from __future__ import annotations

import math
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from llm_session import llm  # noqa: F401
from quarry.llm import gru, lm

SHAPE = gru.Shape(head=11, tails=3, hidden=5, per_class=4)


def model(dtype=np.float32):
    m = gru.Gru.fresh(SHAPE, np.arange(1, 15).astype(float))
    m.p["u"][:] = np.random.default_rng(0).normal(0, 0.5, m.p["u"].shape)
    return gru.Gru(SHAPE, m.theta.astype(dtype))


def sequences(seed=1, n=9):
    rng = np.random.default_rng(seed)
    return [np.append(rng.integers(1, 14, rng.integers(0, 30)), 0).astype(np.int32) for _ in range(n)]


def test_probabilities_sum_to_one():
    m = model()
    h = np.random.default_rng(2).normal(size=(1, 5)).astype(np.float32)
    p = np.exp(m.logp(np.repeat(h, 14, axis=0), np.arange(14, dtype=np.int32))[0])
    assert abs(p.sum() - 1) < 1e-5


def test_state_is_carried_and_cleared():
    """Windows and lanes don't change a document's score; documents don't see each other."""
    m, docs = model(), sequences()
    alone = [gru.score(m, [d], 1, 1000, 0)[0] for d in docs]
    for width, steps in ((1, 1), (2, 3), (4, 7), (64, 16)):
        assert np.allclose(gru.score(m, docs, width, steps, 0), alone, atol=1e-3)
    d = docs[0]
    h, want, before = np.zeros((1, 5), np.float32), 0.0, 0
    for s in d:
        h = m.step(h, m.p["x"][[before]])[0]
        want += m.logp(h, np.array([s]))[0][0]
        before = s
    assert abs(want - alone[0]) < 1e-3
    assert len(gru.score(m, [], 4, 4, 0)) == 0


def test_gradients():
    m, docs = model(np.float64), sequences()
    (_, out, g), = gru.windows(m, docs, 64, 1000, 0, True)  # one window: nothing is truncated
    flat = np.concatenate([g[name].ravel() for name, _ in SHAPE.parts()])
    rng = np.random.default_rng(3)
    for i in rng.choice(len(flat), 60, replace=False):
        old = m.theta[i]
        if old < -1000:
            continue
        m.theta[i] = old + 1e-3
        up = gru.score(m, docs, 64, 1000, 0).sum()
        m.theta[i] = old - 1e-3
        down = gru.score(m, docs, 64, 1000, 0).sum()
        m.theta[i] = old
        assert abs((up - down) / 2e-3 - flat[i]) < 1e-2 * max(1, abs(flat[i]))


def test_training_learns_context():
    m = model()
    docs = [np.array([1, 2, 3, 4] * 10 + [0], np.int32) for _ in range(50)]
    before = gru.score(m, docs[:1], 1, 16, 0)[0]
    adam = gru.Adam(SHAPE.size(), 0.02)
    for _ in range(30):
        gru.train(m, docs, 8, 8, 0, adam)
    assert gru.score(m, docs[:1], 1, 16, 0)[0] > before / 5


def test_training_carries_the_state_through_long_documents():
    """Each window of a long document starts from the state and symbol that the one before ended with."""
    rng = np.random.default_rng(5)
    doc = np.append(rng.integers(1, 14, 2900), 0).astype(np.int32)
    m, adam = model(), gru.Adam(SHAPE.size(), 0.01)
    gru.train(m, [doc], 4, 16, 0, adam)
    want, adam = model(), gru.Adam(SHAPE.size(), 0.01)
    h, before = np.zeros((1, 5), np.float32), 0
    for t in range(0, len(doc), 16):
        g, caches, inputs, states = {k: np.zeros_like(v) for k, v in want.p.items()}, [], [], []
        for s in doc[t : t + 16]:
            nxt, *cache = want.step(h, want.p["x"][[before]])
            caches.append((h, np.array([False]), *cache))
            inputs.append(np.array([before], np.int32))
            states.append(nxt)
            h, before = nxt, s
        _, dh = want.logp(np.concatenate(states), doc[t : t + 16], g)
        gru._backward(want, g, caches, inputs, dh)
        flat = np.concatenate([g[name].ravel() for name, _ in SHAPE.parts()]) / (4 * 16)
        norm = float(np.sqrt(flat @ flat))
        adam.ascend(want.theta, flat if norm <= 1 else flat / norm)
    assert np.allclose(m.theta, want.theta, atol=1e-4)


def test_size_of_the_registered_network():
    """96 classes of the output: 32 of head words and 64 of tail words."""
    p = lm.Params()
    shape = gru.Shape(p.head, p.tails, p.hidden)
    assert (p.head, p.tails, shape.classes) == (1024, 64, 96)
    assert len({lm.tail_of(bytes([a, b]), p) for a in range(97, 123) for b in range(97, 123)}) == 64


def calls(f) -> int:
    """Calls of Python and C functions that ``f`` makes."""
    n = [0]

    def count(frame, event, arg):
        n[0] += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        f()
    finally:
        sys.setprofile(None)
    return n[0]


def test_words_of_the_head_are_scored_together():
    """Only the products are made class by class: before, a window with gradients made 206 counted
    calls for 16 classes, now 100; the probabilities are those of each token alone."""
    shape = gru.Shape(head=512, tails=8, hidden=4)
    rng = np.random.default_rng(4)
    m = gru.Gru.fresh(shape, rng.integers(1, 900, 520).astype(float))
    h, target = rng.normal(size=(4000, 4)).astype(np.float32), rng.integers(0, 520, 4000).astype(np.int32)
    g = {k: np.zeros_like(v) for k, v in m.p.items()}
    assert calls(lambda: m.logp(h, target, g)) < 150
    out, _ = m.logp(h, target)
    one = [m.logp(h[i : i + 1], target[i : i + 1])[0][0] for i in range(0, 4000, 40)]
    assert np.allclose(out[::40], one, atol=1e-5)


def odd_vocabulary(p: lm.Params) -> lm.Vocabulary:
    frequent = [(b"a", 9), (b"", 7), (b"bb", 5), (b"\xc3\xa9", 4), (b"ccc", 2)]
    return lm.Vocabulary(p, 40, 12, frequent, np.full(p.tails, 3.0), np.full(p.tails, 2.0))


def test_texts_are_read_as_defined():
    """Symbols of whole batches against the definition: blanks, other control characters, bytes above ASCII."""
    p = lm.Params(head=4, tails=8)
    vocab = odd_vocabulary(p)
    texts = [b"", b" \t", b"A bb\x0b\x0cccc\r\n ", "É é x\x1cy z\x85".encode(), b"q zz " * 40, b"a", b"\xff\xfe b\x00"]
    want = [[vocab.symbol.get(w, vocab.head + lm.tail_of(w, p)) for w in [*t.lower().split(), b""]] for t in texts]
    every = pa.array([b"skipped", *texts], pa.binary())
    for here in (every[1:], every[1:4], every[:0]):
        got = lm.Lookup(vocab).documents(here)[0]
        assert got.to_pylist() == want[: len(here)]
    words, ends = lm.split_words(every[1:])
    assert [words[a:b].to_pylist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == [t.lower().split() for t in texts]


def test_reading_makes_no_call_per_word():
    """50,000 different words that are not among the frequent ones (one call each before)."""
    lookup = lm.Lookup(odd_vocabulary(lm.Params(head=4, tails=8)))
    texts = pa.array([" ".join(f"w{i * 100 + j}" for j in range(100)).encode() for i in range(500)], pa.binary())
    assert calls(lambda: lookup.documents(texts)) < 500


def test_tables_are_cut_at_the_row_that_fills_them():
    p = lm.Params(head=4, tails=8, buffer=10)
    lookup = lm.Lookup(odd_vocabulary(p))
    sizes = [3, 4, 2, 30, 0, 0, 9, 1, 8, 2]
    rows = pa.array([b"a " * n for n in sizes], pa.binary())
    batches = [pa.record_batch([rows[a:b]], ["t"]) for a, b in ((0, 6), (6, 6), (6, 7), (7, 10))]
    got = [len(x) for t in lm._buffered(iter(batches), p, lambda b: pa.record_batch([lookup.documents(b.column(0))[0]], ["s"])) for x in [lm._arrays(t["s"])]]
    assert got == [3, 1, 3, 2, 1]


def corpus():
    rng = random.Random(8)
    langs = [[f"{c}{i}" for i in range(300)] for c in "abc"]
    rows = []
    for i in range(400):
        words = langs[i % 3]
        rows.append((i, " ".join(words[min(int(rng.expovariate(0.03)), 299)] for _ in range(rng.randrange(5, 60)))))
    rows += [(1000, None), (1001, ""), (1002, "A0 a0\tA0 unseenword É é"), (None, "a1 b2 zz"), (5, rows[5][1]), (1004, "y" * 200_000 + " a0")]
    return rows


def test_scores_equal_brute_force(llm):
    rows = corpus()
    table = llm.createDataFrame([(*r, 1, "c", 0.5, 7) for r in rows], "doc_id long, text string, c int, word string, base double, _row long")
    p = lm.Params(head=64, tails=8, known=100, lanes=32, buffer=3000)
    got = lm.score(table.repartition(3), "doc_id", "text", p).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    toks = [(t or "").encode().lower().split() + [b""] for _, t in rows]
    c = Counter(w for (i, _), t in zip(rows, toks, strict=True) if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    want = []
    for (i, _), t in zip(rows, toks, strict=True):
        base = sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)
        want.append((i or -1, held(i), len(t), sum(c[w] > 0 for w in t), n, round(base, 6)))
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    out = [r for r in got if r.held_out and r.n_tokens > 4]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)  # context helps on texts not seen
    assert len({r.score for r in got if r.doc_id in (1000, 1001)}) == 1
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert all(r.score < 0 for r in got)


def test_nothing_to_score_or_learn(llm):
    table = llm.createDataFrame([], "doc_id long, text string")
    assert lm.score(table, "doc_id", "text").count() == 0
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.score(llm.createDataFrame([(only, "a b")], "doc_id long, text string"), "doc_id", "text").first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0) and abs(r.base_score) < 1e-9


def test_warm_up_is_bounded_and_not_needed(llm, monkeypatch):
    """Many equal rows give no more than warm_texts of them; long texts alone train all the same."""
    sizes, train = [], gru.train
    monkeypatch.setattr(gru, "train", lambda m, docs, *a: (sizes.append(len(docs)), train(m, docs, *a)))
    rows = [("same words here",)] * 900 + [(f"w{i % 7} v{i % 5}",) for i in range(20)]
    texts = llm.createDataFrame(rows, "t string").selectExpr("cast(null as string) as key", "cast(t as binary) as t").repartition(3)
    p = lm.Params(head=16, tails=4, known=20, lanes=8, warm_texts=50)
    vocab = lm.vocabulary(lm.count_words(texts), p)
    lm.train(texts, vocab, p)
    assert 0 < sizes[0] <= 50
    none = lm.Params(head=16, tails=4, known=20, lanes=8, warm_bytes=1)
    fresh = gru.Gru.fresh(gru.Shape(vocab.head, 4, none.hidden), vocab.frequency()).theta
    assert np.abs(lm.train(texts, vocab, none) - fresh).max() > 1e-4


def test_tail_shares_sum_to_one(llm):
    table = llm.createDataFrame(corpus(), "doc_id long, text string")
    p = lm.Params(head=64, tails=8, known=100)
    counts = lm.count_words(table.selectExpr("cast(coalesce(text, '') as binary) as t"))
    vocab = lm.vocabulary(counts, p)
    every = [(bytes(r.word), r.c) for r in counts.collect()]
    for t in range(8):
        mine = [c for w, c in every if w not in vocab.symbol and lm.tail_of(w, p) == t]
        assert vocab.tail_n[t] == sum(mine) and vocab.tail_v[t] == len(mine)
        assert abs(sum(10 ** vocab.within_tail(c, t) for c in [*mine, 0]) - 1) < 1e-9
