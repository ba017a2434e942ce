"""The reference's upsert/delete fixture, worked out by hand (best first, ties to larger id)."""

from pyspark.sql import functions as F

from quarry.operators import lifecycle as L
from quarry.operators import rank as R

# commit, op, id, title
OPS = [
    (1, "upsert", "x", "a b c"),
    (1, "upsert", "y", "a b"),
    (1, "upsert", "z", "a"),
    (2, "upsert", "v", "c c"),
    (2, "upsert", "w", "c c c"),
    (3, "delete", "v", None),
    (4, "upsert", "x", "a b a b"),
    (4, "upsert", "y", "c c c c"),
]


def _log(spark):
    rows = [(c, i, op, t, n) for n, (c, op, i, t) in enumerate(OPS)]
    return spark.createDataFrame(rows, "commit_id long, doc_id string, op string, title string, seq long")


def _select(log, at, term):
    log = log.where(F.col("commit_id") <= at)
    lp = L.live_postings(L.segment_postings(log), L.live_keys(log))
    top = R.topk(lp.where(F.col("term") == term), 10, score="tf")
    return [(r.doc_id, r.tf) for r in top.orderBy("rank").collect()]


def test_fixture_commits(spark):
    log = _log(spark)
    assert _select(log, 1, "b") == [("y", 1), ("x", 1)]
    assert _select(log, 2, "c") == [("w", 3), ("v", 2), ("x", 1)]
    assert _select(log, 3, "c") == [("w", 3), ("x", 1)]
    assert _select(log, 4, "c") == [("y", 4), ("w", 3)]


def test_upsert_in_same_commit_as_delete_wins(spark):
    rows = [(1, "a", "upsert", "t1", 0), (2, "a", "delete", None, 1), (2, "a", "upsert", "t2", 2), (2, "b", "delete", None, 3)]
    log = spark.createDataFrame(rows, "commit_id long, doc_id string, op string, title string, seq long")
    live = {r.doc_id: r.title for r in L.live_view(log).collect()}
    assert live == {"a": "t2"}  # the delete of absent "b" is ignored


def test_last_write_in_commit_wins(spark):
    rows = [(1, "a", "upsert", "old", 0), (1, "a", "upsert", "new", 1)]
    log = spark.createDataFrame(rows, "commit_id long, doc_id string, op string, title string, seq long")
    assert [r.title for r in L.upserts_per_commit(log).collect()] == ["new"]


def test_merge_rewrites_two_segments_and_keeps_live_rows(spark):
    log = _log(spark)
    segments, live, counts = L.segment_postings(log), L.live_keys(log), L.segment_live_counts(log)
    name = F.col("segment")
    before = {tuple(r) for r in L.live_postings(segments, live).collect()}
    same = L.merge_two_smallest(segments, live, counts)  # no more than ten segments: nothing happens
    assert {tuple(r) for r in same.collect()} == {tuple(r) for r in segments.select(F.col("commit_id").cast("string"), "term", "doc_id", "tf").collect()}
    merged = L.merge_two_smallest(segments, live, counts, at_most=2)
    new = {tuple(r) for r in merged.where(name.contains("+")).select("term", "doc_id", "tf").collect()}
    assert new <= before  # the merged segment holds live rows only
    kept = merged.where(~name.contains("+")).select("term", "doc_id", "tf", name.cast("bigint").alias("commit_id"))
    assert {tuple(r) for r in L.live_postings(kept, live).collect()} | new == before
    assert merged.select("segment").distinct().count() <= counts.count() - 1


def test_truncate_empties_and_replays(spark):
    rows = [(1, "a", "upsert", "t1", 0), (2, "b", "upsert", "t2", 1), (4, "a", "upsert", "t3", 2)]
    log = spark.createDataFrame(rows, "commit_id long, doc_id string, op string, title string, seq long")
    assert L.live_view(L.truncate(log, 4)).count() == 0
    assert {r.doc_id: r.title for r in L.live_view(L.truncate(log, 2)).collect()} == {"a": "t3"}
    assert L.live_view(log, at_commit=2).count() == 2


def test_live_rows_and_counts(spark):
    log = _log(spark)
    assert {tuple(r) for r in L.live_term_counts(log).collect()} == {
        tuple(r) for r in L.live_postings(L.segment_postings(log), L.live_keys(log)).collect()
    }


def test_streamed_log_equals_batch(spark):
    import __spark_entry__ as E
    from conftest import SF001

    got, want = (E.queries()[n](spark, SF001) for n in ("stream_upserts", "commit_snapshot"))
    assert got.count() > 0 and {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}


def test_sampled_terms_are_hashed_once(spark):
    """the hash meets the distinct terms, above their aggregate, and the sample is the definition's."""
    import hashlib

    words = [f"w{i}" for i in range(3000)]
    rows = [(w, i % 7, 1) for i, w in enumerate(words * 2)]
    postings = spark.createDataFrame(rows, "term string, doc_id long, tf long")
    for m in (100, 7, 4):
        got = L.hash_sample_terms(postings, m)
        assert sorted(r.term for r in got.collect()) == sorted(w for w in words if int(hashlib.md5(w.encode()).hexdigest(), 16) % m == 0)
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert plan.rindex("md5(") < plan.index("Aggregate")
