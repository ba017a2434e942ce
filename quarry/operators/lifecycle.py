"""Corpus lifecycle as an append-only operation log and snapshots derived from it.

Log rows: (commit_id, doc_id, op in {upsert, delete}, title, seq). Semantics at commit c:
  * several writes of one id in one commit: the last (by seq) wins;
  * a delete becomes visible at the next commit and applies to versions from EARLIER commits
    only, so an upsert in the same commit as a delete wins;
  * deleting an absent id does nothing.
A document is live at c iff its latest upsert commit u <= c exists and no delete has commit
in (u, c]. Every step is a per-document aggregate (max / max_by), combined map-side before the
shuffle, so an id with a third of all operations does not overload one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import md5_mod
from quarry.operators import index as I
from quarry.operators.util import one_row


def upserts_per_commit(log: DataFrame) -> DataFrame:
    """Last write per (commit, id): (commit_id, doc_id, title)."""
    up = log.where(F.col("op") == "upsert")
    return up.groupBy("commit_id", "doc_id").agg(F.max_by("title", "seq").alias("title"))


def live_view(log: DataFrame, at_commit=None) -> DataFrame:
    """(doc_id, commit_id, title) of the documents live at ``at_commit`` (default: latest), in one
    aggregate over the log. A truncate (op of a row without id) removes every earlier version."""
    if at_commit is not None:
        log = log.where(F.col("commit_id") <= F.lit(at_commit))
    upsert = F.col("op") == "upsert"
    docs = log.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.when(upsert, F.col("commit_id"))).alias("u"),
        F.max_by("title", F.when(upsert, F.struct("commit_id", "seq"))).alias("title"),
        F.max(F.when(F.col("op") == "delete", F.col("commit_id"))).alias("dmax"),
    )
    live = docs.where(F.col("u").isNotNull() & (F.col("dmax").isNull() | (F.col("dmax") <= F.col("u"))))
    cut = log.agg(F.max(F.when(F.col("op") == "truncate", F.col("commit_id"))).alias("cut"))
    live = live.crossJoin(one_row(cut)).where(F.col("cut").isNull() | (F.col("u") > F.col("cut")))
    return live.select("doc_id", F.col("u").alias("commit_id"), "title")


def truncate(log: DataFrame, commit_id) -> DataFrame:
    """The log with a truncate at ``commit_id``: what it and earlier commits wrote is gone."""
    spark = log.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in log.schema}
    row = spark.range(1).select(
        *[
            {"op": F.lit("truncate"), "commit_id": F.lit(commit_id)}.get(c, F.lit(None)).cast(kinds[c]).alias(c)
            for c in log.columns
        ]
    )
    return log.unionByName(row)


def live_rows(log: DataFrame) -> DataFrame:
    """The log's rows that wrote the live version of a document, found from the narrow columns; titles
    move once, to meet their keys, and dead versions go before anything reads their text."""
    upsert = F.col("op") == "upsert"
    keys = log.groupBy("doc_id").agg(
        F.max(F.when(upsert, F.struct("commit_id", "seq"))).alias("w"),
        F.max(F.when(F.col("op") == "delete", F.col("commit_id"))).alias("dmax"),
    )
    keys = keys.where(F.col("w").isNotNull() & (F.col("dmax").isNull() | (F.col("dmax") <= F.col("w.commit_id"))))
    keys = keys.select("doc_id", F.col("w.commit_id").alias("commit_id"), F.col("w.seq").alias("seq"))
    return log.where(upsert).join(keys, ["doc_id", "commit_id", "seq"], "left_semi")


def live_term_counts(log: DataFrame) -> DataFrame:
    """(term, doc_id, tf) of the live documents, counted within each live row."""
    return I.build_tf_postings(live_rows(log), "doc_id", "title").select("term", "doc_id", "tf")


def live_keys(log: DataFrame) -> DataFrame:
    """(doc_id, commit_id) of live documents from the narrow columns only (no titles shuffled)."""
    k = log.groupBy("doc_id").agg(
        F.max(F.when(F.col("op") == "upsert", F.col("commit_id"))).alias("u"),
        F.max(F.when(F.col("op") == "delete", F.col("commit_id"))).alias("dmax"),
    )
    return k.where(F.col("u").isNotNull() & (F.col("dmax").isNull() | (F.col("dmax") <= F.col("u")))).select(
        "doc_id", F.col("u").alias("commit_id")
    )


def committed_counts(log: DataFrame) -> DataFrame:
    """Per commit, the number of distinct ids it (re)wrote: the commit report."""
    return log.where(F.col("op") == "upsert").groupBy("commit_id").agg(F.countDistinct("doc_id").alias("n_committed"))


def segment_postings(log: DataFrame) -> DataFrame:
    """Immutable per-commit tf postings: (commit_id, term, doc_id, tf)."""
    batch = upserts_per_commit(log)
    toks = batch.select("commit_id", "doc_id", F.explode(I.tok_whitespace(F.col("title"))).alias("term"))
    return toks.groupBy("commit_id", "term", "doc_id").agg(F.count(F.lit(1)).alias("tf"))


def live_postings(segments: DataFrame, live: DataFrame) -> DataFrame:
    """Postings of the live version of each document (segment postings semi-joined to the live set)."""
    return segments.join(live.select("doc_id", "commit_id"), ["doc_id", "commit_id"], "left_semi").select("term", "doc_id", "tf")


def segment_live_counts(log: DataFrame) -> DataFrame:
    """Live documents per segment (commit), zero for fully dead segments."""
    commits = log.select("commit_id").distinct()
    live = live_view(log).groupBy("commit_id").agg(F.count(F.lit(1)).alias("n_live"))
    return commits.join(live, "commit_id", "left").select("commit_id", F.coalesce("n_live", F.lit(0)).alias("n_live"))


MAX_SEGMENTS = 10


def merge_two_smallest(segments: DataFrame, live: DataFrame, counts: DataFrame, at_most: int = MAX_SEGMENTS) -> DataFrame:
    """One maintenance step over (commit_id, term, doc_id, tf) postings, returned with ``segment``: with
    more than ``at_most`` segments, the two with the fewest live documents (ties: later commit first)
    are rewritten as one, 'a+b', that holds their live rows only; the others stay as they are.

    ``counts`` has one row per segment, so the choice is a top 2, broadcast if it measures small."""
    n = counts.agg(F.count(F.lit(1)).alias("segments"))
    two = counts.orderBy("n_live", F.desc("commit_id")).limit(2).crossJoin(one_row(n)).where(F.col("segments") > at_most)
    name = two.agg(F.concat_ws("+", F.min("commit_id").cast("string"), F.max("commit_id").cast("string")).alias("merged"))
    chosen = two.select(F.col("commit_id").alias("c")).crossJoin(one_row(name))
    tagged = segments.join(chosen, F.col("commit_id") == F.col("c"), "left")
    kept = live.select(F.col("doc_id").alias("d"), F.col("commit_id").alias("lc"))
    small = tagged.where(F.col("c").isNotNull()).join(kept, (F.col("doc_id") == F.col("d")) & (F.col("commit_id") == F.col("lc")), "left_semi")
    rest = tagged.where(F.col("c").isNull()).select(F.col("commit_id").cast("string").alias("segment"), "term", "doc_id", "tf")
    return rest.unionByName(small.select(F.col("merged").alias("segment"), "term", "doc_id", "tf"))


def in_hash_sample(term_col: str = "term", m: int = 100):
    """int(md5(term), 16) % m == 0. A number divisible by 4 ends in the hex digit 0, 4, 8 or c: if m is, the
    digit leaves a quarter of the terms for the division of 128 bits."""
    hit = md5_mod(term_col, m) == 0
    last = F.substring(F.md5(F.col(term_col).cast("string")), 32, 1)
    return last.isin("0", "4", "8", "c") & hit if m % 4 == 0 else hit


def hash_sample_terms(postings: DataFrame, m: int = 100) -> DataFrame:
    """Vocabulary terms with int(md5(term), 16) % m == 0, from live postings only. A term is hashed once, not
    with each of its postings: the condition reads the count, so it is not moved below the aggregate."""
    vocabulary = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return vocabulary.where(F.when(F.col("n") > 0, in_hash_sample("term", m))).select("term")


def bulk_query(postings: DataFrame, m: int = 100, k: int = 10) -> DataFrame:
    """Every sampled term as a single-term query, best k by tf each. The sample is a per-term
    predicate, so it filters the postings directly: no join and nothing broadcast, however
    large the sampled vocabulary grows."""
    from quarry.operators.rank import topk_batch

    hits = postings.where(in_hash_sample("term", m))
    return topk_batch(hits, "term", k, score="tf").select("term", "rank", "doc_id", "tf")
