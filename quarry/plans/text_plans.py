"""Scans, filters, analyzers and index-building queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as A
from quarry.functions.hashing import md5_mod
from quarry.functions.porter_sql import stems_sql
from quarry.functions.scoring import is_relevant, label_gain
from quarry.operators import index as I
from quarry.plans import sql as Q
from quarry.plans.registry import register
from quarry.session import scratch_path
from quarry.sources import records as REC
from quarry.sources.tables import judgments, read_table, spread


def _docs(spark, d):
    return read_table(spark, d, "documents")


def _texts(spark, d):
    return spread(read_table(spark, d, "documents").select("doc_id", "text"))


def _docs_rows(spark, d):
    """Documents for per-row analyzer work: spread over the task slots when the input has few files."""
    return spread(read_table(spark, d, "documents"))


def _digest(tokens):
    """(n_tokens, md5 of tokens joined by U+0001): checks every token with a small output."""
    return [F.size(tokens).cast("bigint").alias("n_tokens"), F.md5(F.array_join(tokens, "\u0001")).alias("digest")]


def _sql_digest(list_expr: str) -> str:
    return f"len({list_expr}) AS n_tokens, md5(array_to_string({list_expr}, chr(1))) AS digest"


WS = Q.ws("text")
PUNCT = "string_split_regex(text, '\\p{P}+')"

# ---- 2.1 scans, sources, sinks -------------------------------------------------------------


@register("scan_corpus", "SELECT doc_id, lang, source, n_chars, length(text)::BIGINT AS text_chars FROM documents")
def scan_corpus(spark, d):
    return _docs(spark, d).select("doc_id", "lang", "source", "n_chars", F.length("text").cast("bigint").alias("text_chars"))


@register("scan_judgments", f"WITH {Q.JUDG} SELECT query_id, query, doc_id, label, split, title FROM judg")
def scan_judgments(spark, d):
    return judgments(spark, d).select("query_id", "query", "doc_id", "label", "split", "title")


BODY = 1000


@register(
    "ingest_json",
    """SELECT user_id, e.doc_id, e.title FROM (
         SELECT user_id, unnest(from_json(to_json(list({'doc_id': CAST(event_id AS VARCHAR), 'title': event_type}
                ORDER BY event_id)), '[{"doc_id":"VARCHAR","title":"VARCHAR"}]')) AS e
         FROM events GROUP BY user_id)""",
)
def ingest_json(spark, d):
    """JSON arrays of {doc_id, title} records (update bodies of one user, of at most BODY events)
    parsed back to rows."""
    ev = read_table(spark, d, "events")
    body = F.floor(F.col("event_id") / BODY).alias("body_no")  # bounds a body whatever a user writes
    bodies = ev.groupBy("user_id", body).agg(
        F.to_json(
            F.transform(
                F.array_sort(F.collect_list(F.struct("event_id", "event_type"))),
                lambda x: F.struct(x["event_id"].cast("string").alias("doc_id"), x["event_type"].alias("title")),
            )
        ).alias("body")
    )
    return bodies.select("user_id", F.inline(F.from_json("body", REC.RECORD_ARRAY)))


@register("export_json", "SELECT to_json({'p_partkey': p_partkey, 'p_name': p_name, 'p_brand': p_brand}) AS json FROM part")
def export_json(spark, d):
    return REC.export_json(read_table(spark, d, "part"), ["p_partkey", "p_name", "p_brand"])


@register(
    "json_files",
    "SELECT doc_id, md5(coalesce(text, '')) AS digest, lang, source, n_chars FROM documents",
)
def json_files(spark, d):
    """The documents written as JSON lines and read back."""
    docs, path = spread(read_table(spark, d, "documents")), scratch_path(spark, "json")
    REC.write_json(docs, path)
    back = REC.read_json(spark, path, docs.schema)
    return back.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("digest"), "lang", "source", "n_chars")


@register("save_load_index", f"WITH {Q.DOC_TF} SELECT term, doc_id, tf FROM tfp")
def save_load_index(spark, d):
    path = scratch_path(spark, "index")
    REC.save_index(I.build_tf_postings(_texts(spark, d), "doc_id", "text").select("term", "doc_id", "tf"), path)
    return REC.load_index(spark, path).select("term", "doc_id", "tf")


@register("sample_rows")
def sample_rows(spark, d):
    """Seeded 1 % Bernoulli sample of the corpus (the sampling operator itself)."""
    return _docs(spark, d).sample(fraction=0.01, seed=0).select("doc_id", "source")


@register("random_row", "SELECT doc_id, source FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || ':7'), doc_id LIMIT 1")
def random_row(spark, d):
    """One row at random: the least of a seeded hash, a partial top 1."""
    seeded = F.md5(F.concat(F.col("doc_id").cast("string"), F.lit(":7")))
    return _docs(spark, d).orderBy(seeded, "doc_id").limit(1).select("doc_id", "source")


@register("hash_sample", f"SELECT doc_id, source FROM documents WHERE {Q.md5_mod('CAST(doc_id AS VARCHAR)', 100)} = 0")
def hash_sample(spark, d):
    """Deterministic ~1 % sample: md5(id) % 100 == 0."""
    return _docs(spark, d).where(md5_mod("doc_id", 100) == 0).select("doc_id", "source")


# ---- 2.2 projections, filters ---------------------------------------------------------------


@register("filter_locale", "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'en'")
def filter_locale(spark, d):
    return _docs(spark, d).where(F.col("lang") == "en").select("doc_id", "source", "n_chars")


@register("filter_split", f"WITH {Q.JUDG} SELECT query_id, doc_id, label FROM judg WHERE split = 'train'")
def filter_split(spark, d):
    return judgments(spark, d).where(F.col("split") == "train").select("query_id", "doc_id", "label")


@register("filter_exact_brand", "SELECT p_brand, count(*) AS n FROM part WHERE p_brand = 'Brand#4' GROUP BY p_brand")
def filter_exact_brand(spark, d):
    return read_table(spark, d, "part").where(F.col("p_brand") == "Brand#4").groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"))


@register("scan_for_term", f"SELECT doc_id FROM documents WHERE list_contains({WS}, 'of')")
def scan_for_term(spark, d):
    return _docs_rows(spark, d).where(F.array_contains(A.tok_whitespace("text"), "of")).select("doc_id")


@register(
    "annotate_listing",
    f"WITH {Q.JUDG} SELECT query_id, query, doc_id, title, count(*) OVER (PARTITION BY query_id) AS product_count FROM judg",
)
def annotate_listing(spark, d):
    """Pair listing and its count for every query at once (count via partial aggregation + join)."""
    j = judgments(spark, d)
    counts = j.groupBy("query_id").agg(F.count(F.lit(1)).alias("product_count"))
    return j.select("query_id", "query", "doc_id", "title").join(counts, "query_id")


@register(
    "lookup_by_id",
    "SELECT d.doc_id, d.source, d.n_chars FROM (SELECT DISTINCT doc_id FROM labels) l JOIN documents d USING (doc_id)",
)
def lookup_by_id(spark, d):
    ids = read_table(spark, d, "labels").select("doc_id").distinct()
    return ids.join(_docs(spark, d).select("doc_id", "source", "n_chars"), "doc_id")


@register(
    "project_label_gain",
    f"""WITH {Q.JUDG} SELECT query_id, doc_id, label,
        CASE label WHEN 'E' THEN 4 WHEN 'S' THEN 2 WHEN 'C' THEN 1 ELSE 0 END AS gain,
        CASE WHEN label <> 'I' THEN 1 ELSE 0 END AS relevant FROM judg""",
)
def project_label_gain(spark, d):
    j = judgments(spark, d)
    return j.select("query_id", "doc_id", "label", label_gain("label").alias("gain"), is_relevant("label").alias("relevant"))


# ---- 2.3 text analysis -----------------------------------------------------------------------


@register("tok_as_is", f"SELECT p_partkey, {_sql_digest('[p_brand]')} FROM part")
def tok_as_is(spark, d):
    return read_table(spark, d, "part").select("p_partkey", *_digest(A.tok_as_is("p_brand")))


@register("tok_whitespace", f"SELECT doc_id, {_sql_digest(WS)} FROM documents")
def tok_whitespace(spark, d):
    return _docs_rows(spark, d).select("doc_id", *_digest(A.tok_whitespace("text")))


@register("tok_punctuation", f"SELECT doc_id, {_sql_digest(PUNCT)} FROM documents")
def tok_punctuation(spark, d):
    return _docs_rows(spark, d).select("doc_id", *_digest(A.tok_punctuation("text")))


_POSS = f"list_transform({WS}, lambda x: regexp_replace(x, '(''|''s)$', ''))"


@register("flt_possessive", f"SELECT doc_id, {_sql_digest(_POSS)} FROM documents")
def flt_possessive(spark, d):
    return _docs_rows(spark, d).select("doc_id", *_digest(A.flt_possessive(A.tok_whitespace("text"))))


@register("flt_lowercase", f"SELECT doc_id, {_sql_digest(f'list_transform({WS}, lambda x: lower(x))')} FROM documents")
def flt_lowercase(spark, d):
    return _docs_rows(spark, d).select("doc_id", *_digest(A.flt_lowercase(A.tok_whitespace("text"))))


# A small English stop list for the stop-term filter query.
STOP_TERMS = ["a", "an", "and", "in", "is", "of", "on", "the", "to", "was"]
_STOP_SQL = "[" + ", ".join(f"'{s}'" for s in STOP_TERMS) + "]"


@register(
    "flt_stop_terms",
    f"SELECT doc_id, {_sql_digest(f'list_filter({WS}, lambda x: NOT list_contains({_STOP_SQL}, x))')} FROM documents",
)
def flt_stop_terms(spark, d):
    return _docs_rows(spark, d).select("doc_id", *_digest(A.flt_stop_terms(A.tok_whitespace("text"), STOP_TERMS)))


# Entries "term,part of speech" of a stop table, and the parts that stop.
STOP_ENTRIES = ["the,DT", "a,DT", "of,IN", "in,IN", "on,IN", "and,CC", "is,VBZ", "was,VBD", "to,TO"]
STOP_PARTS = ["DT", "IN", "CC"]
_ENTRIES_SQL = ", ".join(f"('{e}')" for e in STOP_ENTRIES)
_PARTS_SQL = ", ".join(f"'{x}'" for x in STOP_PARTS)


@register(
    "flt_stop_table",
    f"""WITH stop AS (SELECT split_part(e, ',', 1) AS term FROM (VALUES {_ENTRIES_SQL}) t(e) WHERE split_part(e, ',', 2) IN ({_PARTS_SQL}))
        SELECT doc_id, pos, term FROM (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term
          FROM (SELECT doc_id, {WS} AS t FROM documents)) WHERE term NOT IN (SELECT term FROM stop)""",
)
def flt_stop_table(spark, d):
    """Tokens not in a stop table of any size, whose entries carry a part of speech."""
    entries = spark.createDataFrame([(e,) for e in STOP_ENTRIES], "entry string")
    stop = entries.where(F.substring_index("entry", ",", -1).isin(STOP_PARTS)).select(F.substring_index("entry", ",", 1).alias("term"))
    tokens = I.token_table(_texts(spark, d), "doc_id", "text").withColumn("pos", F.col("pos").cast("bigint"))
    return tokens.join(stop, "term", "left_anti").select("doc_id", "pos", "term")


_KATA = "list_transform(" + WS + ", lambda x: regexp_replace(x, '^(\\p{Katakana}{3,})ー$', '\\1'))"


@register("flt_katakana_stem", "SELECT doc_id, " + _sql_digest(_KATA) + " FROM documents")
def flt_katakana_stem(spark, d):
    return _docs_rows(spark, d).select("doc_id", *_digest(A.flt_katakana_stem(A.tok_whitespace("text"))))


_CHAIN = f"list_transform(list_transform({WS}, lambda x: regexp_replace(x, '(''|''s)$', '')), lambda y: lower(y))"


@register("analyze_chain", f"SELECT doc_id, {_sql_digest(_CHAIN)} FROM documents")
def analyze_chain(spark, d):
    an = A.chain(A.tok_whitespace, A.flt_possessive, A.flt_lowercase)
    return _docs_rows(spark, d).select("doc_id", *_digest(an(F.col("text"))))


@register("distinct_tokens", f"SELECT doc_id, len(list_distinct({WS})) AS n_distinct FROM documents")
def distinct_tokens(spark, d):
    return _docs_rows(spark, d).select("doc_id", F.size(F.array_distinct(A.tok_whitespace("text"))).cast("bigint").alias("n_distinct"))


@register(
    "token_positions",
    f"SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term FROM (SELECT doc_id, {WS} AS t FROM documents)",
)
def token_positions(spark, d):
    return I.token_table(_texts(spark, d), "doc_id", "text").withColumn("pos", F.col("pos").cast("bigint"))


@register("token_count", f"SELECT doc_id, coalesce(len({WS}), 0) AS len FROM documents")
def token_count(spark, d):
    return I.doc_lengths(_docs_rows(spark, d), "doc_id", "text").withColumn("len", F.col("len").cast("bigint"))


_VOLUME = {
    "whitespace": WS,
    "punctuation": PUNCT,
    "whitespace_lower": f"list_transform({WS}, lambda x: lower(x))",
    "punctuation_lower": f"list_transform({PUNCT}, lambda x: lower(x))",
    "whitespace_possessive_lower": _CHAIN,
}


@register(
    "analyzer_volume",
    "SELECT analyzer, n_tokens FROM (SELECT "
    + ", ".join(f"sum(len({e}))::BIGINT AS \"{k}\"" for k, e in _VOLUME.items())
    + " FROM documents WHERE text IS NOT NULL) UNPIVOT (n_tokens FOR analyzer IN ("
    + ", ".join(f'"{k}"' for k in _VOLUME)
    + "))",
)
def analyzer_volume(spark, d):
    """Tokens emitted per analyzer over the corpus, all analyzers in one scan (then unpivot)."""
    docs = _docs_rows(spark, d).where(F.col("text").isNotNull())
    sums = docs.agg(*[F.sum(F.size(A.ANALYZERS[k](F.col("text")))).cast("bigint").alias(k) for k in _VOLUME])
    return sums.unpivot([], list(_VOLUME), "analyzer", "n_tokens")


# ---- 2.4 index-building aggregations ---------------------------------------------------------


@register("vocabulary_counts", f"SELECT term, count(*) AS cf FROM (SELECT unnest({WS}) AS term FROM documents) GROUP BY term")
def vocabulary_counts(spark, d):
    return I.vocabulary_counts(_texts(spark, d), "text")


@register(
    "build_postings",
    f"SELECT DISTINCT term, doc_id FROM (SELECT doc_id, unnest({WS}) AS term FROM documents WHERE text IS NOT NULL)",
)
def build_postings(spark, d):
    return I.build_postings(_texts(spark, d), "doc_id", "text")


@register("build_keyword_index", "SELECT p_brand AS term, p_partkey AS doc_id FROM part WHERE p_brand IS NOT NULL")
def build_keyword_index(spark, d):
    return I.build_keyword_index(read_table(spark, d, "part"), "p_partkey", "p_brand")


@register("build_tf_postings", f"WITH {Q.DOC_TF} SELECT term, doc_id, tf, doc_len FROM tfp")
def build_tf_postings(spark, d):
    return I.build_tf_postings(_texts(spark, d), "doc_id", "text").withColumn("doc_len", F.col("doc_len").cast("bigint"))


@register(
    "build_positional",
    f"""SELECT term, doc_id, count(*) AS n_pos, array_to_string(list(pos ORDER BY pos), ',') AS positions
        FROM (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term
              FROM (SELECT doc_id, {WS} AS t FROM documents WHERE text IS NOT NULL))
        GROUP BY term, doc_id""",
)
def build_positional(spark, d):
    p = I.build_positional(_texts(spark, d), "doc_id", "text")
    return p.select("term", "doc_id", F.size("positions").cast("bigint").alias("n_pos"), F.array_join("positions", ",").alias("positions"))


@register("term_lookup", f"WITH {Q.DOC_TF} SELECT doc_id, tf FROM tfp WHERE term = 'of'")
def term_lookup(spark, d):
    """One term from a stored index: only its bucket's folder is read."""
    path = scratch_path(spark, "index")
    REC.save_index(I.build_tf_postings(_texts(spark, d), "doc_id", "text").select("term", "doc_id", "tf"), path)
    return REC.lookup_saved(REC.load_index(spark, path), "of").select("doc_id", "tf")


@register(
    "dense_doc_ids",
    """WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents)
       SELECT l.doc_id, n.idx, n.doc_id AS decoded FROM labels l JOIN n USING (doc_id)""",
)
def dense_doc_ids(spark, d):
    """Labelled documents under dense document ids, and decoded again."""
    ids = I.dense_ids(_docs(spark, d).select("doc_id"), "doc_id")
    encoded = read_table(spark, d, "labels").select("doc_id").join(ids, "doc_id")
    return encoded.join(ids.withColumnRenamed("doc_id", "decoded"), "idx").select("doc_id", "idx", "decoded")


@register(
    "dense_term_ids",
    f"SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM (SELECT DISTINCT unnest({WS}) AS term FROM documents)",
)
def dense_term_ids(spark, d):
    """Dense integer ids for the vocabulary in term order (distributed numbering)."""
    vocab = I.vocabulary_counts(_texts(spark, d), "text").select("term")
    return I.dense_ids(vocab, "term")


@register("term_df", f"WITH {Q.DOC_TF} SELECT term, count(*) AS df FROM tfp GROUP BY term")
def term_df(spark, d):
    return I.term_df(I.build_postings(_texts(spark, d), "doc_id", "text"))


@register("doc_length_avg", f"WITH {Q.DOC_STATS} SELECT n_docs, round(avg_len, 6) AS avg_len FROM st")
def doc_length_avg(spark, d):
    return I.corpus_stats(_texts(spark, d), "doc_id", "text").select("n_docs", F.round("avg_len", 6).alias("avg_len"))


_LOW = f"list_transform({WS}, lambda x: lower(x))"
_STEMS_SQL = f"""tk AS (SELECT doc_id, unnest({_LOW}) AS term FROM documents WHERE text IS NOT NULL),
voc AS (SELECT DISTINCT term FROM tk), st AS ({stems_sql('voc')})"""


@register(
    "flt_porter_stem",
    f"WITH {_STEMS_SQL} SELECT stem AS term, doc_id, count(*) AS tf FROM tk JOIN st USING (term) GROUP BY stem, doc_id",
)
def flt_porter_stem(spark, d):
    """Postings of the whole corpus re-keyed by Porter stem (vocabulary job)."""
    postings = I.build_tf_postings(_texts(spark, d), "doc_id", "text", A.flt_lowercase_after(A.tok_whitespace))
    return I.stem_postings(postings.select("term", "doc_id", "tf"))


@register("stem_vocabulary", f"WITH {_STEMS_SQL} SELECT term, stem FROM st")
def stem_vocabulary(spark, d):
    """(term, stem) for every distinct lowercased token."""
    postings = I.build_postings(_texts(spark, d), "doc_id", "text", A.flt_lowercase_after(A.tok_whitespace))
    return I.stem_vocabulary(postings)
