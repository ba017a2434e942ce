"""Decontamination, line dedup and toxicity against brute force and on odd rows."""

from __future__ import annotations

import random

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_session import llm  # noqa: F401
from quarry.llm import decontaminate as dc
from quarry.llm import linededup as ld
from quarry.llm import toxicity as tx

DOC = "doc_id long, text string, hits int, h string, score double, `in` int, removed int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 0.5, 2, 3) for r in rows], DOC)


def distance_inside(item: str, text: str) -> int:
    """Least edits between the item and any part of the text."""
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = i
        for j, d in enumerate(text, 1):
            new[j] = min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1)
        row = new
    return int(row.min())


def edit(rng, text: str, n: int) -> str:
    t = list(text)
    for _ in range(n):
        i = rng.randrange(len(t))
        kind = rng.randrange(3)
        if kind == 0:
            t[i] = rng.choice("xyz ")
        elif kind == 1:
            del t[i]
        else:
            t.insert(i, rng.choice("xyz"))
    return "".join(t)


def test_q_gram_search_equals_brute_force():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randrange(2, 6)))
    items = [(str(i), dc.normal(" ".join(word() for _ in range(rng.randrange(6, 16))))) for i in range(12)] + [("short", "abc")]
    index = dc.Index(items, dc.Params())
    found = missed = 0
    for _ in range(60):
        parts = [word() for _ in range(20)]
        for _ in range(rng.randrange(3)):
            i, t = rng.choice(items)
            parts.insert(rng.randrange(len(parts)), edit(rng, t, rng.randrange(0, 6)))
        text = dc.normal(" ".join(parts))
        got = {i: (s, e, d) for i, s, e, d in index.search(text)}
        for n, (i, t) in enumerate(items):
            best = distance_inside(t, text)
            if best <= index.k[n]:
                s, e, d = got[i]
                assert d == best and (d > 0 or text[s:e] == t) and distance_inside(text[s:e], t) <= best
                found += 1
            else:
                assert i not in got
                missed += 1
    assert found > 30 and missed > 30


def test_contaminated_rows_and_clean_rows(llm):
    item = "the quick brown fox jumps over the lazy dog while the cat sleeps on a warm mat"
    rows = [(1, f"Intro words. {item.upper()}  and  more"), (1, f"Intro words. {item.upper()}  and  more"), (2, "nothing here"), (3, None), (4, "")]
    rows += [(None, "x " + item.replace("jumps", "jumped")), (6, "pad " * 40_000 + item)]
    bench = llm.createDataFrame([(7, item), (8, item), (9, None), (10, ""), (None, "qq zz")], "item_id long, text string")
    got = sorted((r.doc_id or -1, r.item_id, r.edits) for r in dc.contaminated(docs(llm, rows), "doc_id", "text", bench, "item_id", "text").collect())
    assert got == sorted((d, i, 2 if d == -1 else 0) for d in (1, 1, -1, 6) for i in (7, 8))
    clean = dc.clean(docs(llm, rows), "text", bench, "item_id", "text")
    assert sorted(r.doc_id for r in clean.collect()) == [2, 3, 4] and clean.columns == docs(llm, rows).columns
    one_by_one = dc.Params(block_chars=10)  # every item a block of its own
    assert dc.contaminated(docs(llm, rows), "doc_id", "text", bench, "item_id", "text", one_by_one).count() == 8
    assert dc.contaminated(docs(llm, []), "doc_id", "text", bench, "item_id", "text").count() == 0
    assert dc.contaminated(docs(llm, rows), "doc_id", "text", bench.limit(0), "item_id", "text").count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=14), st.lists(st.sampled_from("abcdefg"), max_size=14))
def test_patience_pairs_rise_and_match(a, b):
    got = ld.patience(a, b)
    assert all(a[i] == b[j] for i, j in got)
    assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))
    assert bool(got) == bool(set(a) & set(b))
    if a == b:
        assert got == [(i, i) for i in range(len(a))]


def lines(n, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta".split()) + str(rng.randrange(99)) for _ in range(12)) for _ in range(n)]


def common_blocks(later, earlier, min_words):
    """Lines of ``later`` in any stretch of consecutive lines, of enough words, that ``earlier`` holds too."""
    out = set()
    a, b = ld.split_lines(later), ld.split_lines(earlier)
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i][1] != b[j][1] or (i and j and a[i - 1][1] == b[j - 1][1]):
                continue
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n][1] == b[j + n][1]:
                n += 1
            if sum(x[2] for x in a[i : i + n]) >= min_words:
                out |= {x[0] for x in a[i : i + n]}
    return out


def brute(rows, p):
    """Every document against every earlier one."""
    keys = sorted({(i, t) for i, t in rows if i is not None and t})
    keys = [k for k in keys if len(k[1]) < 100_000]
    gone = {b: set().union(*[common_blocks(b[1], a[1], p.min_words) for a in keys[:n]]) for n, b in enumerate(keys)}
    return [sorted(gone.get((i, t), ())) for i, t in rows]


def test_line_dedup_equals_brute_force(llm):
    rng = random.Random(1)
    passage, other, common = lines(5, 1), lines(3, 2), "A short common line."
    rows = []
    for i in range(24):
        own = lines(rng.randrange(1, 6), 100 + i)
        if i % 2:
            at = rng.randrange(len(own) + 1)
            own[at:at] = passage
        if i % 5 == 0:
            own += other
        own.insert(rng.randrange(len(own) + 1), common)
        if i % 3 == 0:
            own.insert(1, "")
        rows.append((i * 10, "\n".join(own)))
    rows += [rows[3], rows[3], (None, rows[5][1]), (500, None), (501, ""), (502, "\n\n"), (503, rows[7][1]), (504, "one line " * 30_000)]
    p = ld.Params(rare=4)
    out = ld.dedup_lines(docs(llm, rows).repartition(3), "doc_id", "text", p)
    assert out.columns == [*docs(llm, []).columns, "removed_lines"]
    got = sorted(((r.doc_id if r.doc_id is not None else -1), r.text, list(r.removed_lines)) for r in out.collect() if r.text is not None)
    want = []
    for (i, t), cut in zip(rows, brute(rows, p), strict=True):
        if t is not None:
            kept = "\n".join(x for n, x in enumerate(t.split("\n")) if n not in cut) if cut else t
            want.append((i if i is not None else -1, kept, cut))
    assert got == sorted(want)
    texts = {r[0]: r[1] for r in got}
    assert passage[2] in texts[10] and not any(passage[2] in t for i, t in texts.items() if i > 10)
    # too short to go by itself; it goes where it stands beside a passage as in an earlier document
    alone = [i for i, t, cut in got if i % 10 == 0 and i < 240 and not cut]
    assert len(alone) >= 8 and all(common in texts[i] for i in alone)
    assert ld.dedup_lines(docs(llm, []), "doc_id", "text").count() == 0


def test_every_block_of_an_earlier_document_goes(llm):
    """Lines that are each common alone: as if compared with every earlier document."""
    rng = random.Random(4)
    stock = [f"stock {n} " + " ".join(["word"] * rng.randrange(2, 9)) for n in range(12)]
    rows = [(n, f"{line}\nown {n}") for n, line in enumerate(stock)]  # the first holders have one line each
    for i in range(60):
        own = [f"own {i} {j}" for j in range(rng.randrange(1, 4))]
        for _ in range(rng.randrange(1, 3)):  # also two blocks, in any order or twice
            at, size = rng.randrange(11), rng.randrange(1, 6)
            own[1:1] = stock[at : at + size]
        rows.append((100 + i, "\n".join(own)))
    p = ld.Params()
    got = {r.doc_id: list(r.removed_lines) for r in ld.dedup_lines(docs(llm, rows).repartition(3), "doc_id", "text", p).collect()}
    want = dict(zip([i for i, _ in rows], brute(rows, p), strict=True))
    assert sum(map(len, want.values())) > 50 and got == want


def test_blocks_in_another_order_go(llm):
    """Documents 1 to 13 hold the two blocks of document 0 the other way round."""
    x, y = ([f"{c}{n} " + "word " * 5 for n in range(4)] for c in "xy")
    rows = [(0, "\n".join([*y, "own 0", *x]))] + [(i, "\n".join([*x, f"own {i}", *y])) for i in range(1, 14)]
    got = {r.doc_id: list(r.removed_lines) for r in ld.dedup_lines(docs(llm, rows), "doc_id", "text").collect()}
    assert got == {0: [], **{i: [0, 1, 2, 3, 5, 6, 7, 8] for i in range(1, 14)}}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 2), st.integers(1, 9)), max_size=14))
def test_shortest_runs_cover_every_block(steps):
    seq, pos = [], 0
    for n, (step, words) in enumerate(steps):
        pos += step
        seq.append({"pos": pos, "h": bytes([n]) * 16, "words": words})
    got = set(ld.runs(seq, 12))
    for a in range(len(seq)):
        for b in range(a + 1, len(seq) + 1):
            block = seq[a:b]
            if block[-1]["pos"] - block[0]["pos"] == b - a - 1 and sum(x["words"] for x in block) >= 12:
                inside = [(i, j) for i in range(a, b) for j in range(i + 1, b + 1) if sum(x["words"] for x in seq[i:j]) >= 12]
                found = [(i, j) for i, j in inside if xxhash.xxh3_128_digest(b"".join(x["h"] for x in seq[i:j])) in got]
                assert {k for i, j in found for k in range(i, j)} == set(range(a, b))


def test_toxicity_learns_and_scores_whole_texts(llm):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice(["ba", "du", "ki", "lo", "me", "na"]) for _ in range(rng.randrange(1, 4)))
    rows, marks = [], []
    for i in range(900):
        t = [word() for _ in range(rng.randrange(10, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                t.insert(rng.randrange(len(t)), rng.choice(["zorgwitz", "Quaxhund", "vexbrut"]))
        rows.append((i, " ".join(t)))
        marks.append((i, int(toxic)))
    odd = [(None, "ba du"), (5000, None), (5001, ""), (5002, "ba du " * 100_000 + "zorgwitz quaxhund vexbrut"), (5002, "x")]
    labels = llm.createDataFrame([*marks, (None, 1), (3, None), (7, 1), (7, 0)], "doc_id long, toxic int")
    table = docs(llm, rows + odd)
    model = tx.fit(tx.labelled_rows(table, labels, "doc_id", "text", "toxic"))
    got = tx.score(table, model, "doc_id", "text", carry=("text", "h")).collect()
    assert len(got) == len(rows + odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    truth = dict(marks)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 200 and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got if r.doc_id is not None)
    assert not next(r for r in got if r.doc_id is None).held_out
    empty = {r.score for r in got if not r.text}
    assert len(empty) == 1
    none = tx.fit(tx.labelled_rows(table, labels.limit(0), "doc_id", "text", "toxic"))
    assert {r.score for r in tx.score(table, none, "doc_id", "text").collect()} == {0.5}
    assert tx.score(docs(llm, []), model, "doc_id", "text").count() == 0


def test_toxicity_fit_sample_is_bounded(llm):
    rows = [(i, "good text " + str(i)) for i in range(60)] + [(100 + i, "vile filth " + str(i)) for i in range(60)]
    labels = llm.createDataFrame([(i, int(i >= 100)) for i, _ in rows], "doc_id long, toxic int")
    table = docs(llm, rows)
    model = tx.fit(tx.labelled_rows(table, labels, "doc_id", "text", "toxic"), tx.Params(fit_rows=20, min_df=2))
    got = tx.score(table, model, "doc_id", "text").collect()
    assert np.mean([(r.score > 0.5) == (r.doc_id >= 100) for r in got]) > 0.95
