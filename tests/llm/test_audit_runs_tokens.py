"""The filter audit, periodic runs and the token file against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations

import numpy as np
import pyarrow.orc as orc
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF01
from llm_session import SF001, llm  # noqa: F401
from quarry.llm import audit, periodic, queries, tokenfile
from quarry.llm.common import read
from quarry.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, source string, runs string, code int, part int, ids string, start string, n_tokens int, _id int, quality int"
EXTRA = ("x", 1, 2, "y", "z", 3, 4, 5)


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, *EXTRA) for i, t, s in rows], DOCS)


# ---- filter audit -----------------------------------------------------------------------------


def audited(rows, labels):
    """Every document taken through every order."""
    first, good, toxic = {}, {}, {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, q, x in labels:
        good[i], toxic[i] = good.get(i) or q == 1, toxic.get(i) or x == 1
    out = {}
    for i, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and i > first[t],
        }
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((s or "", "".join(order), step), dict.fromkeys(audit.NAMES[3:], 0))
                removed = fails[f] and not gone
                row["redundant"] += fails[f] and gone
                row["unique_fails"] += fails[f] and sum(fails.values()) == 1
                gone = gone or fails[f]
                row["kept"] += not gone
                row["removed"] += removed
                row["good_lost"] += bool(removed and i is not None and good.get(i))
                row["toxic_lost"] += bool(removed and i is not None and toxic.get(i))
    total = {}
    for (s, o, step), row in out.items():
        total[s, o[step - 1]] = total.get((s, o[step - 1]), 0) + row["removed"]
    return {k: {**v, "shapley": total[k[0], k[1][k[2] - 1]]} for k, v in out.items()}


def as_dict(df):
    got = df.collect()
    rows = {(r.part, r.filter_order, r.step): {c: r[c] for c in audit.NAMES[3:]} for r in got}
    assert len(rows) == len(got)
    return rows


def test_audit_equals_brute_force(llm):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["Ab", "CD", "#x", "né"]
    rows = []
    for i in range(150):
        text = " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 49, 50, 51, 90])))
        rows.append((i, text, rng.choice(["a", "b", "", None])))
    rows += [(200 + i, rows[i % 9][1], "a") for i in range(60)]  # copies, some of them under another source
    rows += [(7, rows[7][1], "a"), (7, rows[7][1], "a"), (None, rows[3][1], "b"), (None, None, None), (400, None, "a"), (401, "", "a")]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 200, 2)] + [(4, 1, 1), (4, None, None), (None, 1, 1)]
    marks = llm.createDataFrame([(i, q, int(x) if x is not None else None, "s") for i, q, x in labels], "doc_id long, quality int, toxic int, source string")
    got = as_dict(audit.audit(docs(llm, rows).repartition(7), marks))
    assert got == audited(rows, labels)
    assert len(got) == 600 * 3
    assert audit.audit(docs(llm, []), marks).count() == 0
    assert as_dict(audit.audit(docs(llm, rows[:9]), marks.limit(0))) == audited(rows[:9], [])


def test_many_parts_and_partial_sums(llm):
    """More parts than a task holds open, and a part in every task."""
    rows = [(str(i % 300 if i % 3 else 0), i % 128) for i in range(4000)]
    table = llm.createDataFrame(rows, "part string, code int").repartition(9)
    partial = audit.mapped(table, "ABCDE", held=16)
    assert partial.count() > 9 * 20
    whole = audit.added(partial.repartition("part").sortWithinPartitions("part"))
    got = {r.part: (r.n, int.from_bytes(r.total, "little")) for r in whole.collect()}
    _, wide = audit.table("ABCDE")
    want: dict = {}
    for p, c in rows:
        n, t = want.get(p, (0, 0))
        want[p] = n + 1, t + wide[c]
    assert got == want
    assert audit.interactions(table, "ABCDE").where("step = 1").groupBy("part").count().where("count = 120").count() == len(want)


def test_counters_do_not_run_over():
    layout, wide = audit.table("ABCDE")
    n = (1 << audit.WIDTH) - 1  # the most documents that a part may have
    for code in (1, 31, 127):
        assert (layout.counters(n * wide[code]) == n * layout.counters(wide[code])).all()
    assert set(layout.counters(wide[31 + 32])[600 * 2 : 600 * 3]) == {0, 1}


def test_audit_query(llm):
    rows = [(r.doc_id, r.text, r.source) for r in read(llm, SF001, "documents").collect()]
    labels = [(r.doc_id, r.quality, r.toxic) for r in read(llm, SF001, "labels").collect()]
    assert as_dict(queries.QUERIES["op11_filter_audit"](llm, SF001)) == audited(rows, labels)


# ---- periodic runs ----------------------------------------------------------------------------


def runs_of(words):
    """By definition: every lag's maximal stretches, without those of a smaller period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i - s + q
            if length < max(6, 4 * q):
                continue
            if not any(all(words[x] == words[x + p] for x in range(s, s + length - p)) for p in range(1, q)):
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words):
    drop = {i for s, length, q in runs_of(words) for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in drop)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeating(rng):
    out = []
    for _ in range(rng.randint(0, 6)):
        if rng.random() < 0.6:
            unit = [rng.choice("abcd"[: rng.randint(1, 4)]) for _ in range(rng.randint(1, 70))]
            out += (unit * 9)[: int(len(unit) * rng.uniform(2, 7))]
        else:
            out += [rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))]
    return out


def test_runs_equal_brute_force(llm):
    rng = random.Random(5)
    texts = [" ".join(repeating(rng)) for _ in range(120)]
    unit = [f"u{i}" for i in range(500)]
    texts += [" ".join(unit * 5), "a " * 700, "\t a\x0b\x0ca\r\na a a a \n", "né né né né né né", "x\x1cy  z", " ".join(unit * 3)]
    odd = [(None, "b b b b b b c", "s"), (900, None, "s"), (901, "", "s"), (902, "  \n", "s"), (3, texts[3], "s"), (3, texts[3], "s")]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + odd
    got = periodic.detect(docs(llm, rows).repartition(5), "doc_id", "text").collect()
    key = lambda r: (r[0] is None, r[0], r[1], r[2])
    want = [(i, runs_of(split(t)), collapsed(split(t))) for i, t, _ in rows]
    assert sorted(((r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got), key=key) == sorted(want, key=key)
    assert sum(len(w[1]) for w in want) > 200 and max(q for w in want for _, _, q in w[1]) == 500
    assert periodic.detect(docs(llm, []), "doc_id", "text").count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("ab"), max_size=150), st.integers(1, 40), st.integers(0, 8))
def test_runs_of_two_letters(words, cut, times):
    words = words + words[:cut] * times
    found, texts = periodic._group([" ".join(words).encode(), b"a"])
    assert found == [runs_of(words), []] and texts == [collapsed(words).encode(), b"a"]


def test_long_text_is_linear():
    rng = random.Random(1)
    words = [str(rng.randint(0, 999)).encode() for _ in range(100_000)]
    found, _ = periodic._group([b" ".join(words * 5), b" ".join(words)])
    assert found == [[(0, 500_000, 100_000)], []]
    assert periodic._group([b"a " * 300_000])[0] == [[(0, 300_000, 1)]]


def test_runs_query(llm):
    got = {r.doc_id: r for r in queries.QUERIES["op12_periodic_runs"](llm, SF001).collect()}
    texts = {r.doc_id: r.text for r in read(llm, SF001, "documents").collect()}
    assert set(got) == set(texts)
    planted = 0
    for i, text in texts.items():
        words = split(text)
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[j] if j < a else words[a + (j - a) % p] for j in range(n)]
            planted += 1
        if n > 4000:
            continue  # too long for the brute force
        runs = runs_of(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        r = got[i]
        assert r.n_runs == len(runs)
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(words).encode()).hexdigest()
    assert planted > 5


# ---- token file -------------------------------------------------------------------------------


def plain(texts):
    enc = tokenfile.encoder(VOCABULARY).tokenizer
    return [e.ids for e in enc.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_encoder_equals_the_library(text):
    ids, sizes = tokenfile.encoder(VOCABULARY).encode([text], 1)
    assert ids.tolist() == [*plain([text])[0], 1] and sizes.tolist() == [len(ids)]


def test_encoder_on_odd_texts():
    odd = [chr(c) for c in [*range(33), 0x85, 0xA0, 0x300, 0x308, 0x1680, 0x2003, 0x2028, 0x3000, 0xFEFF, 0x10FFFF]]
    texts = [f"Ab{c}{d}'s 12" for c in odd for d in odd] + ["ΑΣ ΟΔΟΣ.", "é ́e", "<|endoftext|> a<|startoftext|>b", "x" * 3000, "İstanbul ǅ ﬁ"]
    ids, sizes = tokenfile.encoder(VOCABULARY).encode(texts, 1)
    want = [[*p, 1] for p in plain(texts)]
    assert ids.tolist() == [i for p in want for i in p] and sizes.tolist() == [len(p) for p in want]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abtsdlvemrXYZ019''.,-<|>#ÀÉßéüÿ× ÷²ª\n"), max_size=40))
def test_plain_words_equal_the_library(text):
    assert tokenfile.encoder(VOCABULARY).encode([text, "", text], 7)[0].tolist() == [*plain([text])[0], 7, 7, *plain([text])[0], 7]


def test_every_text_of_the_table_and_a_full_memory():
    texts = [r or "" for r in pq.read_table(f"{SF01}/documents.parquet", columns=["text"])["text"].to_pylist()]
    enc = tokenfile.Encoder(VOCABULARY)
    enc.memory = tokenfile.Memory(500)
    want = plain(texts)
    for at in range(0, len(texts), 10):
        ids, _ = enc.encode(texts[at : at + 10], 1)
        assert ids.tolist() == [i for p in want[at : at + 10] for i in [*p, 1]]
    assert enc.memory.old
    assert enc.encode([], 1)[0].tolist() == []


def test_encoder_refuses_files_that_keep_white_space():
    with pytest.raises(ValueError, match="white space"):
        tokenfile.Encoder(public_tokenizers.path("byte_bpe_50k.json"))


def test_round_trip(llm):
    rows = [(i * 7 % 400 - 50, f"Text {i % 11} of " * (i % 6), "s") for i in range(400)]
    rows += [(None, "né", "s"), (None, None, "s"), (1000, None, "s"), (1001, "", "s"), (1002, "long words follow " * 30_000, "s")]
    rows += [(5, "equal", "s")] * 200
    path = scratch_path(llm, "tokens")
    tokenfile.write(docs(llm, rows).repartition(6), "doc_id", "text", path, VOCABULARY)
    got = sorted(tokenfile.documents(llm, path).withColumn("c", tokenfile.ids_crc32("ids")).collect(), key=lambda r: r.start)
    ids = [r.doc_id if r.doc_id is not None else -(10**9) for r in got]
    assert ids == sorted(ids) and len(got) == len(rows)
    at, held = 0, []
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
        held.append((r.doc_id, tuple(r.ids)))
        assert r.c == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    key = lambda x: (x[0] is None, x)
    want = [(i, (*p, 1)) for (i, _, _), p in zip(rows, plain([t or "" for _, t, _ in rows]), strict=True)]
    assert sorted(held, key=lambda x: str(key(x))) == sorted(want, key=lambda x: str(key(x)))
    empty = scratch_path(llm, "tokens")
    tokenfile.write(docs(llm, []), "doc_id", "text", empty, VOCABULARY)
    assert tokenfile.documents(llm, empty).count() == 0


def rows_scanned(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else plan
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_stripes_indexes_and_pruning(llm, monkeypatch, tmp_path):
    monkeypatch.setitem(tokenfile.OPTIONS, "orc.stripe.size", str(64 << 10))
    even = llm.range(0, 40_000, 2).selectExpr("id as doc_id", "concat('document ', id, ' ', repeat(md5(cast(id as string)), 3)) as text")
    path = str(tmp_path / "tokens")
    tokenfile.write(even, "doc_id", "text", path, VOCABULARY)
    files = [orc.ORCFile(p) for p in tmp_path.glob("tokens/*.orc")]
    assert sum(f.nstripes for f in files) > len(files) and {f.row_index_stride for f in files} == {1000}
    assert {str(f.compression) for f in files} == {"ZSTD"}
    plan = tokenfile.read(llm, path, doc_ids=[8, 30_000])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id, [" in plan
    found = tokenfile.read(llm, path, doc_ids=[8, 30_000])
    assert sorted(r.doc_id for r in found.collect()) == [8, 30_000] and rows_scanned(found) <= 2_000
    absent = tokenfile.read(llm, path, doc_ids=[3_001])  # within a row group's range, so only its Bloom filter rules it out
    assert rows_scanned(absent) == 0
    span = tokenfile.read(llm, path, low=10_000, high=11_999)
    assert span.count() == 1_000 and rows_scanned(span) <= 3_000
    with_split = llm.conf.get("spark.sql.files.maxPartitionBytes")
    llm.conf.set("spark.sql.files.maxPartitionBytes", str(96 << 10))
    try:
        many = tokenfile.documents(llm, path)
        assert tokenfile.read(llm, path).rdd.getNumPartitions() > len(files)  # stripes are read in parallel
        assert many.agg(F.sum("n_tokens"), F.count(F.lit(1)), F.max(F.col("start") + F.col("n_tokens"))).first()[::2] == many.agg(F.sum("n_tokens"), F.lit(0), F.sum("n_tokens")).first()[::2]
    finally:
        llm.conf.set("spark.sql.files.maxPartitionBytes", with_split)


def test_token_file_query(llm):
    got = sorted(queries.QUERIES["op13_token_file"](llm, SF001).collect())
    rows = sorted((r.doc_id, r.text) for r in read(llm, SF001, "documents").select("doc_id", "text").collect())
    at = 0
    for r, (i, _), ids in zip(got, rows, plain([t or "" for _, t in rows]), strict=True):
        ids = [*ids, 1]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
