"""Corpus lifecycle queries over the events operation log and a two-pass
load of the documents."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from quarry.operators import lifecycle as L
from quarry.operators.segments import Store
from quarry.plans import sql as Q
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources.tables import LOG_SCHEMA, SCHEMAS, documents_load_log, events_log, events_to_log, read_table

LOG_SQL = """log AS (
  SELECT date_diff('day', DATE '1970-01-01', ts::DATE)::BIGINT AS commit_id, user_id AS doc_id,
         CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op,
         CASE WHEN event_type <> 'error' THEN
           array_to_string(list_transform(range(CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 + 1), lambda i: event_type), ' ')
         END AS title,
         event_id AS seq
  FROM events)"""

LIVE_SQL = f"""{LOG_SQL},
up AS (SELECT doc_id, max(commit_id) AS u, arg_max(title, (commit_id, seq)) AS title FROM log WHERE op = 'upsert' GROUP BY doc_id),
dl AS (SELECT doc_id, max(commit_id) AS dmax FROM log WHERE op = 'delete' GROUP BY doc_id),
live AS (SELECT up.doc_id, up.u AS commit_id, up.title FROM up LEFT JOIN dl USING (doc_id) WHERE dl.dmax IS NULL OR dl.dmax <= up.u)"""

SEG_SQL = f"""{LIVE_SQL},
batch AS (SELECT commit_id, doc_id, arg_max(title, seq) AS title FROM log WHERE op = 'upsert' GROUP BY commit_id, doc_id),
seg AS (SELECT commit_id, term, doc_id, count(*) AS tf FROM (
          SELECT commit_id, doc_id, unnest({Q.ws('title')}) AS term FROM batch) GROUP BY commit_id, term, doc_id),
lp AS (SELECT s.term, s.doc_id, s.tf FROM seg s JOIN live l ON l.doc_id = s.doc_id AND l.commit_id = s.commit_id)"""


@register(
    "upsert_batch",
    f"WITH {LOG_SQL} SELECT commit_id, doc_id, arg_max(title, seq) AS title FROM log WHERE op = 'upsert' GROUP BY commit_id, doc_id",
)
def upsert_batch(spark, d):
    return L.upserts_per_commit(events_log(spark, d))


@register("commit_snapshot", f"WITH {LIVE_SQL} SELECT doc_id, commit_id, title FROM live")
def commit_snapshot(spark, d):
    return L.live_view(events_log(spark, d))


@register(
    "commit_report",
    f"WITH {LOG_SQL} SELECT commit_id, count(DISTINCT doc_id) AS n_committed FROM log WHERE op = 'upsert' GROUP BY commit_id",
)
def commit_report(spark, d):
    return L.committed_counts(events_log(spark, d))


@register(
    "delete_deferred",
    f"""WITH {LIVE_SQL} SELECT up.doc_id, up.u AS last_upsert, dl.dmax AS deleted_at
        FROM up JOIN dl USING (doc_id) WHERE dl.dmax > up.u""",
)
def delete_deferred(spark, d):
    """Documents whose last version was deleted by a later commit (deletes of absent ids vanish)."""
    log = events_log(spark, d)
    up = log.where(F.col("op") == "upsert").groupBy("doc_id").agg(F.max("commit_id").alias("last_upsert"))
    dl = log.where(F.col("op") == "delete").groupBy("doc_id").agg(F.max("commit_id").alias("deleted_at"))
    return up.join(dl, "doc_id").where(F.col("deleted_at") > F.col("last_upsert")).select("doc_id", "last_upsert", "deleted_at")


def _store(spark, d):
    """The events' commits as stored segments, one per commit."""
    store = Store(spark, scratch_path(spark, "corpus"))
    store.append(events_log(spark, d))
    return store


@register("segment_build", f"WITH {SEG_SQL} SELECT commit_id, term, doc_id, tf FROM seg")
def segment_build(spark, d):
    """The postings of every commit, written as its segment and read back through the manifest."""
    store = _store(spark, d)
    rows = store.table("postings", store.segments())
    return rows.select(F.col("segment").cast("bigint").alias("commit_id"), "term", "doc_id", "tf")


@register("live_postings", f"WITH {SEG_SQL} SELECT term, doc_id, tf FROM lp")
def live_postings(spark, d):
    return _store(spark, d).live_postings().drop("segment")


@register(
    "segment_manifest",
    f"""WITH {SEG_SQL},
        d AS (SELECT commit_id, count(*) AS n_docs FROM batch GROUP BY commit_id),
        p AS (SELECT commit_id, count(*) AS n_postings FROM seg GROUP BY commit_id),
        lv AS (SELECT commit_id, count(*) AS n_live FROM live GROUP BY commit_id)
        SELECT c.commit_id::VARCHAR AS segment, c.commit_id AS last_commit, coalesce(n_docs, 0) AS n_docs,
               coalesce(n_postings, 0) AS n_postings, coalesce(n_live, 0) AS n_live
        FROM (SELECT DISTINCT commit_id FROM log) c LEFT JOIN d USING (commit_id) LEFT JOIN p USING (commit_id) LEFT JOIN lv USING (commit_id)""",
)
def segment_manifest(spark, d):
    """The newest manifest: each segment's versions and postings, and how many of its documents are live."""
    store = _store(spark, d)
    return store.manifest().join(store.live_counts().drop("last_commit"), "segment")


@register(
    "merge_two_smallest",
    f"""WITH {SEG_SQL},
        cnt AS (SELECT c.commit_id, coalesce(n.n_live, 0) AS n_live FROM (SELECT DISTINCT commit_id FROM log) c
                LEFT JOIN (SELECT commit_id, count(*) AS n_live FROM live GROUP BY commit_id) n USING (commit_id)),
        rk AS (SELECT *, row_number() OVER (ORDER BY n_live, commit_id DESC) AS r, count(*) OVER () AS k FROM cnt),
        two AS (SELECT commit_id FROM rk WHERE r <= 2 AND k > 10),
        mrg AS (SELECT (SELECT min(commit_id)::VARCHAR || '+' || max(commit_id)::VARCHAR FROM two) AS segment, s.term, s.doc_id, s.tf
                FROM seg s JOIN live l ON l.doc_id = s.doc_id AND l.commit_id = s.commit_id WHERE s.commit_id IN (SELECT commit_id FROM two)
                UNION ALL SELECT commit_id::VARCHAR, term, doc_id, tf FROM seg WHERE commit_id NOT IN (SELECT commit_id FROM two))
        SELECT segment, count(*) AS n_postings, count(DISTINCT doc_id) AS n_docs, sum(tf)::BIGINT AS total_tf FROM mrg GROUP BY segment""",
)
def merge_two_smallest(spark, d):
    """The stored segments after a maintenance step: rows, documents and occurrences."""
    store = _store(spark, d)
    store.merge_two_smallest()
    docs = store.table("postings", store.segments()).groupBy("segment", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("tf").alias("tf"))
    return docs.groupBy("segment").agg(F.sum("n").alias("n_postings"), F.count(F.lit(1)).alias("n_docs"), F.sum("tf").alias("total_tf"))


@register(
    "merge_to_limit",
    f"WITH {SEG_SQL} SELECT l.commit_id, s.term, s.doc_id, s.tf FROM seg s JOIN live l ON l.doc_id = s.doc_id AND l.commit_id = s.commit_id",
)
def merge_to_limit(spark, d):
    """The live postings after maintenance has merged segments until no more than the limit are left, and
    files that no manifest names are gone; each with the commit that wrote it."""
    store = _store(spark, d)
    while store.merge_two_smallest() is not None:
        pass
    store.vacuum()
    live = store.live().select("doc_id", "commit_id")
    return store.live_postings().join(live, "doc_id").select("commit_id", "term", "doc_id", "tf")


@register("compact_all", f"WITH {SEG_SQL} SELECT term, doc_id, tf FROM lp")
def compact_all(spark, d):
    """Rewrite all stored segments as one, delete the old ones, and read it back."""
    store = _store(spark, d)
    store.compact()
    store.vacuum()
    return store.table("postings", store.segments()).select("term", "doc_id", "tf")


@register(
    "truncate_corpus",
    f"WITH {LIVE_SQL} SELECT 'before' AS state, count(*) AS n_live FROM live UNION ALL SELECT 'after', 0",
)
def truncate_corpus(spark, d):
    """Live documents before and after a truncate at the last commit, which empties the corpus."""
    log = events_log(spark, d)
    last = log.agg(F.max("commit_id")).first()[0]
    n = F.count(F.lit(1)).alias("n_live")
    before = L.live_view(log).agg(n).select(F.lit("before").alias("state"), "n_live")
    return before.unionByName(L.live_view(L.truncate(log, last)).agg(n).select(F.lit("after").alias("state"), "n_live"))


DOCLOAD_SQL = f"""dl AS (SELECT p * 100 + {Q.md5_mod('CAST(doc_id AS VARCHAR)', 100)} AS commit_id, doc_id, text AS title
       FROM documents CROSS JOIN (SELECT unnest([0, 1]) AS p)),
live AS (SELECT doc_id, max(commit_id) AS commit_id FROM dl GROUP BY doc_id),
lp AS (SELECT term, doc_id, count(*) AS tf FROM (
         SELECT dl.doc_id, unnest({Q.ws('dl.title')}) AS term FROM dl JOIN live USING (doc_id, commit_id))
       GROUP BY term, doc_id),
smp AS (SELECT DISTINCT term FROM lp WHERE {Q.md5_mod('term', 100)} = 0)"""


def _docload_live_postings(spark, d):
    return L.live_term_counts(documents_load_log(spark, d))


@register("hash_sample_terms", f"WITH {DOCLOAD_SQL} SELECT term FROM smp")
def hash_sample_terms(spark, d):
    """~1 % of the live vocabulary after loading the corpus twice in 100 commits each."""
    return L.hash_sample_terms(_docload_live_postings(spark, d))


@register(
    "bulk_query_workload",
    f"""WITH {DOCLOAD_SQL} SELECT term, rank, doc_id, tf FROM (
          SELECT lp.*, row_number() OVER (PARTITION BY term ORDER BY tf DESC, doc_id DESC) AS rank
          FROM lp JOIN smp USING (term)) WHERE rank <= 10""",
)
def bulk_query_workload(spark, d):
    """Every sampled term as a query (best 10 by tf), in one job over the live postings."""
    return L.bulk_query(_docload_live_postings(spark, d), 100, 10)


def _feed(spark, d):
    """The events as a feed that arrives in two halves (by day), and the first and last day."""
    ev = read_table(spark, d, "events")
    lo, hi = ev.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    half = F.datediff(F.to_date("ts"), F.lit(lo)) * 2 > (hi - lo).days
    return [ev.where(~half), ev.where(half)]


def _streamed(spark, d, to_log=events_to_log, max_bytes=256 << 20):
    """The log table after the feed ran twice from one checkpoint. A run that fails is started again."""
    from quarry.streaming.upserts import read_log, stream_log_to_table

    inbox, table, ckpt = (scratch_path(spark, n) for n in ("events-inbox", "corpus-log", "corpus-log-ckpt"))
    for part in _feed(spark, d):  # files arrive, then the stream runs over them
        part.write.mode("append").parquet(inbox)
        for attempt in range(2):
            try:
                stream_log_to_table(spark, inbox, "*.parquet", SCHEMAS["events"], to_log, table, ckpt, max_bytes)
                break
            except StreamingQueryException:
                if attempt:
                    raise
    return read_log(spark, table, LOG_SCHEMA)


@register("stream_upserts", f"WITH {LIVE_SQL} SELECT doc_id, commit_id, title FROM live")
def stream_upserts(spark, d):
    """Structured Streaming: the events arrive as files, and micro-batches append them to the log table by
    foreachBatch (idempotent per batch id), in two runs from one checkpoint; the live view of the log."""
    return L.live_view(_streamed(spark, d))


@register("stream_resumed", f"WITH {LOG_SQL} SELECT commit_id, doc_id, op, title, seq FROM log")
def stream_resumed(spark, d):
    """The log that the stream leaves when the first run dies midway: its batch writes a part of its rows and
    fails, the stream is started again from its checkpoint, runs the batch again, and goes on."""
    died = []

    def dies_once(batch):
        rows = events_to_log(batch)
        if died:
            return rows
        died.append(True)
        return rows.withColumn("seq", F.when(F.pmod("seq", F.lit(2)) == 0, F.raise_error(F.lit("a lost writer")).cast("long")).otherwise(F.col("seq")))

    return _streamed(spark, d, dies_once)
