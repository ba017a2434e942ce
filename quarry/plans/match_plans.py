"""Boolean and phrase queries. Terms play the roles of the reference's
Information / Science / Retrieval: A = 'The', B = 'of', C = 'was'."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions.text import tok_whitespace
from quarry.operators import index as I
from quarry.operators import match as M
from quarry.plans import sql as Q
from quarry.plans.registry import register
from quarry.sources.tables import read_table, spread

A, B, C = "The", "of", "was"
WS = Q.ws("text")
POSTINGS_SQL = f"p AS (SELECT DISTINCT term, doc_id FROM (SELECT doc_id, unnest({WS}) AS term FROM documents WHERE text IS NOT NULL))"
TOKENS_SQL = f"tok AS (SELECT doc_id, unnest(range(len(t))) AS pos, unnest(t) AS term FROM (SELECT doc_id, {WS} AS t FROM documents WHERE text IS NOT NULL))"


def _docs(spark, d):
    return spread(read_table(spark, d, "documents").select("doc_id", "text"))


def _flags(spark, d, *terms):
    return M.term_flags(_docs(spark, d), "doc_id", "text", list(terms))


def _ids_sql(t):
    return f"(SELECT doc_id FROM p WHERE term = '{t}')"


@register(
    "join_pairs",
    "SELECT l.doc_id, l.quality, l.toxic, d.source, d.lang FROM labels l JOIN documents d USING (doc_id)",
)
def join_pairs(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source", "lang")
    return read_table(spark, d, "labels").join(docs, "doc_id").select("doc_id", "quality", "toxic", "source", "lang")


@register("bool_and", f"WITH {POSTINGS_SQL} {_ids_sql(A)} INTERSECT {_ids_sql(B)}")
def bool_and(spark, d):
    return _flags(spark, d, A, B).where("t0 AND t1").select("doc_id")


@register("bool_or", f"WITH {POSTINGS_SQL} {_ids_sql(A)} UNION {_ids_sql(C)}")
def bool_or(spark, d):
    return _flags(spark, d, A, C).where("t0 OR t1").select("doc_id")


@register("bool_and_not", f"WITH {POSTINGS_SQL} {_ids_sql(A)} EXCEPT {_ids_sql(B)}")
def bool_and_not(spark, d):
    return _flags(spark, d, A, B).where("t0 AND NOT t1").select("doc_id")


@register(
    "bool_nested",
    f"WITH {POSTINGS_SQL} ({_ids_sql(A)} UNION {_ids_sql(C)}) EXCEPT ({_ids_sql(A)} INTERSECT {_ids_sql(B)})",
)
def bool_nested(spark, d):
    """(A OR C) AND NOT (A AND B)."""
    return _flags(spark, d, A, B, C).where("(t0 OR t2) AND NOT (t0 AND t1)").select("doc_id")


@register(
    "bool_cross_field",
    """SELECT DISTINCT p_partkey AS doc_id FROM part WHERE list_contains(string_split_regex(p_name, '\\s+'), 'red')
       EXCEPT SELECT p_partkey FROM part WHERE p_brand = 'Brand#4'""",
)
def bool_cross_field(spark, d):
    """Title term AND-NOT exact brand, over two indexes of the part table."""
    part = read_table(spark, d, "part")
    title = I.build_postings(part, "p_partkey", "p_name")
    brand = I.build_keyword_index(part, "p_partkey", "p_brand")
    return M.bool_and_not(M.ids(title, "red"), M.ids(brand, "Brand#4"))


TF_SQL = f"""tfp AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest({WS}) AS term FROM documents
                WHERE text IS NOT NULL) WHERE term IN ('the', 'of') GROUP BY term, doc_id)"""


@register(
    "or_with_tf",
    f"""WITH {TF_SQL}
        SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.tf, 0) AS tf_a, coalesce(b.tf, 0) AS tf_b
        FROM (SELECT * FROM tfp WHERE term = 'the') a FULL OUTER JOIN (SELECT * FROM tfp WHERE term = 'of') b
        ON a.doc_id = b.doc_id""",
)
def or_with_tf(spark, d):
    terms = ["the", "of"]
    both = M.side_by_side(I.build_tf_postings(_docs(spark, d), "doc_id", "text", only=terms), terms, "tf")
    return both.select("doc_id", F.coalesce("v0", F.lit(0)).alias("tf_a"), F.coalesce("v1", F.lit(0)).alias("tf_b"))


POS_SQL = f"""pp AS (SELECT term, doc_id, list(pos ORDER BY pos) AS positions FROM ({TOKENS_SQL[len('tok AS '):]})
              WHERE term IN ('of', 'the', 'was') GROUP BY term, doc_id)"""


def _positional(spark, d, terms):
    return I.build_positional(_docs(spark, d), "doc_id", "text", only=sorted(terms))


def _positions(spark, d, *terms):
    """(doc_id, positions) of the terms side by side; null where a document lacks one."""
    both = M.side_by_side(_positional(spark, d, terms), list(terms), "positions")
    return both.select("doc_id", F.array("v0", "v1").alias("positions"))


@register(
    "and_with_positions",
    f"""WITH {POS_SQL} SELECT a.doc_id, to_json([a.positions, b.positions]) AS positions
        FROM (SELECT * FROM pp WHERE term = 'of') a JOIN (SELECT * FROM pp WHERE term = 'the') b USING (doc_id)""",
)
def and_with_positions(spark, d):
    out = _positions(spark, d, "of", "the").where(~F.exists("positions", F.isnull))
    return out.select("doc_id", F.to_json("positions").alias("positions"))


@register(
    "or_with_positions",
    f"""WITH {POS_SQL} SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, to_json([a.positions, b.positions]) AS positions
        FROM (SELECT * FROM pp WHERE term = 'of') a FULL OUTER JOIN (SELECT * FROM pp WHERE term = 'was') b
        ON a.doc_id = b.doc_id""",
)
def or_with_positions(spark, d):
    return _positions(spark, d, "of", "was").select("doc_id", F.to_json("positions").alias("positions"))


PHRASE_Q = f"""ph AS (SELECT item_id AS query_id, unnest(range(len(t))) AS off, unnest(t) AS term, len(t) AS plen
                FROM (SELECT item_id, {Q.ws('text')} AS t FROM benchmark)
                UNION ALL SELECT -1, 0, 'of', 2 UNION ALL SELECT -1, 1, 'the', 2)"""


@register(
    "phrase_match",
    f"""WITH {TOKENS_SQL}, {PHRASE_Q}
        SELECT DISTINCT query_id, doc_id FROM (
          SELECT query_id, doc_id, pos - off AS start, plen, count(DISTINCT off) AS n
          FROM tok JOIN ph USING (term) GROUP BY query_id, doc_id, start, plen) WHERE n = plen""",
)
def phrase_match(spark, d):
    """Phrases = every whole benchmark item, plus "of the" (query -1)."""
    b = read_table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), tok_whitespace("text").alias("words"))
    own = spark.createDataFrame([(-1, ["of", "the"])], "query_id bigint, words array<string>")
    return M.phrase_search(_docs(spark, d), "doc_id", "text", b.unionByName(own))


# Clause trees for bool_query / rank_tf_positional, mirroring the reference's UI queries.
CLAUSES = {
    1: M.Word(A),
    2: M.And(M.Word(A), M.Word(B)),
    3: M.Or(M.And(M.Word(A), M.Word(B)), M.Word(C)),
    4: M.And(M.Word(A), M.Or(M.Word(B), M.Word(C))),
    5: M.phrase("of", "the"),
    6: M.And(M.Word(A), M.phrase("of", "the")),
    7: M.AndNot(M.Or(M.Word(A), M.Word(C)), M.And(M.Word(A), M.Word(B))),
    8: M.phrase("the"),
}

CLAUSE_SQL = f"""{TOKENS_SQL},
f AS (SELECT doc_id, count(*) FILTER (WHERE term = 'The') AS ta, count(*) FILTER (WHERE term = 'of') AS tb,
             count(*) FILTER (WHERE term = 'was') AS tc, count(*) FILTER (WHERE term = 'the') AS tt
      FROM tok WHERE term IN ('The', 'of', 'was', 'the') GROUP BY doc_id),
phd AS (SELECT DISTINCT a.doc_id FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
        WHERE a.term = 'of' AND b.term = 'the'),
g AS (SELECT f.*, phd.doc_id IS NOT NULL AS ph FROM f LEFT JOIN phd USING (doc_id)),
cl AS (
  SELECT 1 AS query_id, doc_id, ta AS tf FROM g WHERE ta > 0
  UNION ALL SELECT 2, doc_id, ta + tb FROM g WHERE ta > 0 AND tb > 0
  UNION ALL SELECT 3, doc_id, (CASE WHEN ta > 0 AND tb > 0 THEN ta + tb ELSE 0 END) + (CASE WHEN tc > 0 THEN tc ELSE 0 END)
            FROM g WHERE (ta > 0 AND tb > 0) OR tc > 0
  UNION ALL SELECT 4, doc_id, ta + (CASE WHEN tb > 0 THEN tb ELSE 0 END) + (CASE WHEN tc > 0 THEN tc ELSE 0 END)
            FROM g WHERE ta > 0 AND (tb > 0 OR tc > 0)
  UNION ALL SELECT 5, doc_id, tb + tt FROM g WHERE ph
  UNION ALL SELECT 6, doc_id, ta + tb + tt FROM g WHERE ta > 0 AND ph
  UNION ALL SELECT 7, doc_id, (CASE WHEN ta > 0 THEN ta ELSE 0 END) + (CASE WHEN tc > 0 THEN tc ELSE 0 END)
            FROM g WHERE (ta > 0 OR tc > 0) AND NOT (ta > 0 AND tb > 0)
  UNION ALL SELECT 8, doc_id, tt FROM g WHERE tt > 0)"""


def clause_hits(spark, d, clauses=CLAUSES):
    """Hits of the clause trees, over positions of their leaf terms only."""
    return M.bool_query(_positional(spark, d, set().union(*map(M.leaf_terms, clauses.values()))), clauses)


@register("bool_query", f"WITH {CLAUSE_SQL} SELECT query_id, doc_id, tf FROM cl")
def bool_query(spark, d):
    return clause_hits(spark, d)


@register(
    "phrase_in_conjunction",
    f"""WITH {TOKENS_SQL}, {POSTINGS_SQL}
        SELECT DISTINCT a.doc_id FROM tok a JOIN tok b ON a.doc_id = b.doc_id AND b.pos = a.pos + 1
        WHERE a.term = 'of' AND b.term = 'the' AND a.doc_id IN {_ids_sql(A)}""",
)
def phrase_in_conjunction(spark, d):
    """A AND "of the": one tree over one scan."""
    return clause_hits(spark, d, {0: M.And(M.Word(A), M.phrase("of", "the"))}).select("doc_id")
