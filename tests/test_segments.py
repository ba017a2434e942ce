"""Stored segments: manifests, merges that touch two segments only, failures, deletes, vacuum."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import lifecycle as L
from quarry.operators import segments as SG
from quarry.session import scratch_path

SCHEMA = "commit_id long, doc_id long, op string, title string, seq long"


def _log(spark, commits=14, seed=2):
    rng, rows = random.Random(seed), []
    for c in range(commits):
        for _ in range(rng.randint(1, 9)):
            i = rng.randint(0, 15)
            op = "delete" if rng.random() < 0.3 else "upsert"
            title = None if op == "delete" else " ".join(rng.choices("abcde", k=rng.randint(0, 4)))
            rows.append((c, i, op, title, len(rows)))
    rows.append((commits - 1, 99, "delete", None, len(rows)))  # of an id that was never there
    return spark.createDataFrame(rows, SCHEMA)


def _live(log):
    return sorted((r.term, r.doc_id, r.tf) for r in L.live_postings(L.segment_postings(log), L.live_keys(log)).collect())


def _stored(store, version=None):
    return sorted((r.term, r.doc_id, r.tf) for r in store.live_postings(version).collect())


def _files(store):
    out = {}
    for root, _, names in os.walk(store.path):
        for n in names:
            if n.endswith(".parquet") and "manifests" not in root:
                p = os.path.join(root, n)
                out[os.path.relpath(p, store.path)] = os.stat(p).st_mtime_ns
    return out


@pytest.fixture()
def store(spark):
    return SG.Store(spark, scratch_path(spark, "corpus").removeprefix("file:"))


def test_append_commit_by_commit_equals_the_log(spark, store):
    log = _log(spark, 4)
    for c in range(4):
        store.append(log.where(F.col("commit_id") <= c))
        assert _stored(store) == _live(log.where(F.col("commit_id") <= c))
    assert store.versions() == list(range(4)) and len(store.segments()) == 4
    assert _stored(store, 1) == _live(log.where("commit_id <= 1"))  # an older version is still there
    assert store.append(log) == 3 and store.versions() == list(range(4))  # nothing new
    bulk = SG.Store(spark, scratch_path(spark, "corpus"))
    bulk.append(log)
    assert bulk.versions() == [0] and _stored(bulk) == _stored(store)
    assert sorted(map(tuple, bulk.manifest().collect())) == sorted(map(tuple, store.manifest().collect()))


def test_merge_changes_two_segments_only(spark, store):
    log = _log(spark)
    store.append(log)
    before, files, names = _stored(store), _files(store), store.segments()
    counts = sorted((r.n_live, -r.last_commit, r.segment) for r in store.live_counts().collect())
    two = sorted((s for _, _, s in counts[:2]), key=int)
    assert store.merge_two_smallest() == 1
    assert set(names) - set(store.segments()) == set(two) and set(store.segments()) - set(names) == {"+".join(two)}
    after = _files(store)
    assert all(after[f] == t for f, t in files.items())  # no file changed
    assert all(f"segment={'+'.join(two)}" in f.replace("%2B", "+") for f in set(after) - set(files))
    assert _stored(store) == before == _stored(store, 0)
    gone = store.vacuum()
    assert {g.split("segment=")[1] for g in gone} == set(two) and _stored(store) == before
    kept = _files(store)
    assert all(kept[f] == t for f, t in files.items() if f in kept) and store.versions() == [1]


def test_merges_to_the_limit_and_compaction(spark, store):
    log = _log(spark, 7)
    store.append(log)
    steps, want = 0, _live(log)
    while store.merge_two_smallest(at_most=4) is not None:
        steps += 1
        assert _stored(store) == want
    assert steps == 3 and len(store.segments()) == 4
    # a delete that a merge kept still hides an older version, and later commits still apply
    late = spark.createDataFrame([(50, 3, "upsert", "new words", 900), (50, 4, "delete", None, 901)], SCHEMA)
    store.append(late)
    assert _stored(store) == _live(log.unionByName(late))
    store.compact()
    assert len(store.segments()) == 1 and _stored(store) == _live(log.unionByName(late))
    rows = store.table("postings", store.segments())
    assert rows.count() == len(_stored(store))  # dead versions are gone
    later = spark.createDataFrame([(60, 3, "delete", None, 950)], SCHEMA)
    store.append(later)
    assert _stored(store) == _live(log.unionByName(late).unionByName(later))


def test_a_failed_merge_leaves_the_old_manifest(spark, store, monkeypatch):
    log = _log(spark)
    store.append(log)
    before, names = _stored(store), store.segments()
    write = SG.Store._write

    def dies(self, name, rows):
        if name == "docs":
            raise RuntimeError("lost")
        write(self, name, rows)

    monkeypatch.setattr(SG.Store, "_write", dies)
    with pytest.raises(RuntimeError, match="lost"):
        store.merge_two_smallest()
    assert store.versions() == [0] and store.segments() == names and _stored(store) == before
    monkeypatch.undo()
    # a manifest that was begun but not finished is not seen either, and the next attempt replaces it
    os.makedirs(f"{store.path}/manifests/version=1")
    assert store.versions() == [0] and _stored(store) == before
    assert store.merge_two_smallest() == 1 and _stored(store) == before
    with pytest.raises(ValueError, match="no such segments"):
        store.merge([names[0], "nothing"])


def test_empty_corpus(spark, store):
    assert store.segments() == [] and store.live().count() == 0
    assert store.append(spark.createDataFrame([], SCHEMA)) == 0
    assert store.compact() == 1 and store.merge_two_smallest() is None and store.live_postings().count() == 0


def test_stream_resumes_after_a_failed_batch(spark):
    from pyspark.errors import StreamingQueryException

    from quarry.streaming.upserts import read_log, stream_log_to_table

    log = _log(spark, 12)
    inbox, table, ckpt = (scratch_path(spark, n) for n in ("inbox", "table", "ckpt"))
    log.where("commit_id < 6").repartition(4).write.mode("append").parquet(inbox)
    tries = []

    def dies_in_the_second_batch(batch):
        tries.append(1)
        if len(tries) != 2:
            return batch
        return batch.withColumn("seq", F.when(F.pmod("seq", F.lit(2)) == 0, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("seq")))

    args = (spark, inbox, "*.parquet", log.schema, dies_in_the_second_batch, table, ckpt, 1)  # a file is a batch
    with pytest.raises(StreamingQueryException):
        stream_log_to_table(*args)
    half = read_log(spark, table, log.schema).count()
    assert 0 < half < log.where("commit_id < 6").count()
    assert stream_log_to_table(*args)[1] == 3  # the failed batch and the two after it
    log.where("commit_id >= 6").repartition(3).write.mode("append").parquet(inbox)
    assert stream_log_to_table(*args)[1] == 3
    assert stream_log_to_table(*args)[1] == 0  # nothing new
    key = lambda r: r.seq
    assert sorted(read_log(spark, table, log.schema).collect(), key=key) == sorted(log.collect(), key=key)
