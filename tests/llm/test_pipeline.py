"""The pipeline: each stage against a brute-force reading of its own input, and the entry's contract."""

from __future__ import annotations

import numpy as np
import pytest

import corpus_pipeline as cp
from llm_session import SF001, llm  # noqa: F401
from quarry.llm import decontaminate, linededup, minhash, packing, queries
from quarry.llm.common import read, written

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = read(llm, SF001, "documents"), {}
    out["input"] = docs
    for name, stage in cp.STAGES:
        docs = out[name] = written(stage(llm, docs, SF001), f"test-{name}")
    return {k: v.collect() for k, v in out.items()}


def test_stages_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "line_dedup", "minhash", "decontamination", "packing"]
    for name in [n for n, _ in cp.STAGES][:-1]:
        assert set(stages[name][0].asDict()) == {"doc_id", "text", "lang", "source", "n_chars"}
        assert len(stages[name]) <= len(stages["input"])


def test_toxic_documents_go(llm, stages):
    marks = {r.doc_id: r.toxic for r in read(llm, SF001, "labels").collect()}
    kept = {r.doc_id for r in stages["toxicity"]}
    gone = {r.doc_id for r in stages["input"]} - kept
    assert gone and not any(marks.get(i) == 0 for i in gone)
    trained = [i for i, y in marks.items() if y and __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    assert all(i in gone for i in trained)


def test_blocks_go_from_the_later_document(stages):
    before = {r.doc_id: r for r in stages["toxicity"]}
    after = {r.doc_id: r for r in stages["line_dedup"]}
    first = {}
    for i in sorted(before):
        for _, h, _ in linededup.split_lines(before[i].text):
            first.setdefault(h, i)
    for i, r in before.items():
        own = linededup.split_lines(r.text)
        if all(first[h] == i for _, h, _ in own):
            assert after[i].text == r.text and after[i].n_chars == r.n_chars
        elif i in after and after[i].text != r.text:
            lines = [h for _, h, _ in linededup.split_lines(after[i].text)]
            assert all(first[h] != i for _, h, _ in own if h not in lines)
            assert after[i].n_chars == len(after[i].text)
        elif i not in after:
            assert all(first[h] != i for _, h, _ in own)


def test_one_of_each_group_stays(stages):
    rows = stages["line_dedup"]
    sets = [set(minhash.shingles(r.text.encode(), 5, minhash.Words()).tolist()) for r in rows]
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    kept = {r.doc_id for r in stages["minhash"]}
    for n, r in enumerate(rows):
        partners = [rows[m].doc_id for m in range(len(rows)) if m != n and alike(sets[n], sets[m])]
        if not partners:
            assert r.doc_id in kept
        elif r.doc_id not in kept:
            assert min(partners) < r.doc_id or any(p in kept for p in partners)
    left = [sets[n] for n, r in enumerate(rows) if r.doc_id in kept]
    assert not any(alike(a, b) for i, a in enumerate(left) for b in left[:i])


def test_benchmark_passages_go(llm, stages):
    items = [decontaminate.normal(r.text) for r in read(llm, SF001, "benchmark").collect()]
    kept = {r.doc_id for r in stages["decontamination"]}
    for r in stages["minhash"]:
        if any(t in decontaminate.normal(r.text) for t in items):
            assert r.doc_id not in kept
        else:
            assert r.doc_id in kept  # these tables hold whole passages only


def test_packed_ids(stages):
    enc = packing.encoder(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: [*enc(r.text), 1] for r in stages["decontamination"]}
    got: dict = {}
    for r in sorted(stages["packing"], key=lambda r: r.start):
        got.setdefault(r.doc_id, []).extend(np.frombuffer(bytes(r.ids), "<u4").tolist())
    assert got == want


def test_run_equals_the_stages(llm, stages):
    out = cp.run(llm, SF001)
    assert sorted((r.doc_id, r.start, r.length) for r in out.collect()) == sorted((r.doc_id, r.start, r.length) for r in stages["packing"])


def test_every_operator_has_a_query():
    names = list(queries.QUERIES)
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


COLUMNS = {
    "op1_toxicity": "doc_id held_out score predicted",
    "op3_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op4_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5_multi_index": "vec_id n_links component_id kept",
    "op6_lm_scoring": "doc_id held_out n_tokens n_known train_tokens base_score score",
    "op7_html_extraction": "page_id url text n_chars",
    "op9_minhash": "doc_id n_shingles component_id kept",
    "op10_warc": "page_id payload_bytes payload_digest record_type refers_to",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract_columns(llm, name):
    df = queries.QUERIES[name](llm, SF001)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    table = {"op5_multi_index": "embeddings", "op7_html_extraction": "pages", "op10_warc": "pages"}.get(name, "documents")
    n, m = df.count(), read(llm, SF001, table).count()
    assert n >= m if name == "op4_packing" else n == m
