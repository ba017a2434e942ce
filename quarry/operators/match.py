"""Boolean, positional and phrase matching over posting tables.

Set operators work on frames with a unique ``doc_id`` column. The clause builder compiles a
query tree into ONE aggregation: postings of the tree's leaf terms are grouped per document
into a term -> positions map, and the tree becomes two column expressions (matched, tf) over
that map. One shuffle keyed by document, whatever the size of the tree; a hot term only adds
rows to many different document groups.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import tok_whitespace
from quarry.operators.index import let

# ---- set operators on id frames ---------------------------------------------------------------


def ids(postings: DataFrame, term: str) -> DataFrame:
    return postings.where(F.col("term") == F.lit(term)).select("doc_id")


def bool_and(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("doc_id").join(b.select("doc_id"), "doc_id", "left_semi")


def bool_or(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("doc_id").union(b.select("doc_id")).distinct()


def bool_and_not(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("doc_id").join(b.select("doc_id"), "doc_id", "left_anti")


def documents_with_any(docs: DataFrame, id_col: str, text_col: str, terms: list[str], analyzer=tok_whitespace) -> DataFrame:
    """(doc_id) of the documents that hold one of a few literal terms, decided within the row."""
    held = F.arrays_overlap(analyzer(F.col(text_col)), F.array(*[F.lit(t) for t in terms]))
    return docs.where(held).select(F.col(id_col).alias("doc_id"))


def term_flags(docs: DataFrame, id_col: str, text_col: str, terms: list[str], analyzer=tok_whitespace) -> DataFrame:
    """(doc_id, t0, t1, ...): whether a document holds each of a few literal terms, for documents that hold
    any. One scan; the terms are looked for in the row, and only flags move, to meet under their id."""
    has = let(analyzer(F.col(text_col)), lambda t: F.array(*[F.array_contains(t, x) for x in terms]))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), has.alias("has"))
    rows = rows.where(F.exists("has", lambda x: x))
    return rows.groupBy("doc_id").agg(*[F.bool_or(F.get("has", i)).alias(f"t{i}") for i in range(len(terms))])


def side_by_side(postings: DataFrame, terms: list[str], value: str) -> DataFrame:
    """(doc_id, v0, v1, ...): ``value`` of each of a few terms (null without the term) from postings of theirs,
    in one aggregate by document."""
    return postings.groupBy("doc_id").agg(*[F.max(F.when(F.col("term") == t, F.col(value))).alias(f"v{i}") for i, t in enumerate(terms)])


def or_with_tf(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union keeping each side's tf, 0 where absent: (doc_id, tf_a, tf_b)."""
    return (
        a.select("doc_id", F.col("tf").alias("tf_a"))
        .join(b.select("doc_id", F.col("tf").alias("tf_b")), "doc_id", "full_outer")
        .select("doc_id", F.coalesce("tf_a", F.lit(0)).alias("tf_a"), F.coalesce("tf_b", F.lit(0)).alias("tf_b"))
    )


def and_with_positions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intersection; position lists kept in query order: (doc_id, positions ARRAY<ARRAY<INT>>)."""
    return a.select("doc_id", F.col("positions").alias("pa")).join(b.select("doc_id", F.col("positions").alias("pb")), "doc_id").select(
        "doc_id", F.array("pa", "pb").alias("positions")
    )


def or_with_positions(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union; the absent side's position list is null."""
    return a.select("doc_id", F.col("positions").alias("pa")).join(
        b.select("doc_id", F.col("positions").alias("pb")), "doc_id", "full_outer"
    ).select("doc_id", F.array("pa", "pb").alias("positions"))


# ---- phrases over the token table -------------------------------------------------------------


def phrase_table(spark, phrases: dict[int, list[str]]) -> DataFrame:
    rows = [(qid, off, t, len(ts)) for qid, ts in phrases.items() for off, t in enumerate(ts)]
    return spark.createDataFrame(rows, "query_id bigint, off int, term string, plen int")


def phrase_match(tokens: DataFrame, phrases: DataFrame) -> DataFrame:
    """(query_id, doc_id) for documents containing each phrase as consecutive tokens.

    ``tokens``: (doc_id, pos, term); ``phrases``: (query_id, off, term, plen). A token at pos
    matching phrase word ``off`` votes for a start at pos - off; a start with votes from all
    offsets is a match. Grouping is keyed by document, so frequent words do not skew it.
    """
    votes = tokens.join(phrases, "term").select("query_id", "doc_id", (F.col("pos") - F.col("off")).alias("start"), "off", "plen")
    starts = votes.groupBy("query_id", "doc_id", "start", "plen").agg(F.count(F.lit(1)).alias("n"))
    return starts.where(F.col("n") == F.col("plen")).select("query_id", "doc_id").distinct()


def phrase_search(docs: DataFrame, id_col: str, text_col: str, phrases: DataFrame, analyzer=tok_whitespace) -> DataFrame:
    """(query_id, doc_id) for documents containing each whole phrase as consecutive tokens.

    ``phrases``: (query_id, words ARRAY). Each phrase is looked up by its longest word (the first of
    them), which is seldom a common one; where that stands in a document, the phrase is compared
    with the tokens around it, within the row. So the work follows the occurrences of one word
    per phrase, not of all its words. Empty phrases match nothing.
    """
    anchors = phrases.where(F.size("words") > 0).select("query_id", "words", F.array_max(F.transform("words", lambda w, i: F.struct(F.length(w), -i)))["col2"].alias("_i"))
    anchors = anchors.select("query_id", "words", (-F.col("_i")).alias("off")).withColumn("term", F.get("words", F.col("off")))
    tokens = docs.select(F.col(id_col).alias("doc_id"), F.posexplode(analyzer(F.col(text_col))).alias("pos", "term"))
    hits = tokens.join(anchors.select("query_id", "off", "term"), "term").where(F.col("pos") >= F.col("off"))
    starts = hits.groupBy("query_id", "doc_id").agg(F.collect_list(F.col("pos") - F.col("off")).alias("starts"))  # of one document
    both = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_t")).join(starts, "doc_id").join(phrases.select("query_id", "words"), "query_id")
    found = let(analyzer(F.col("_t")), lambda t: F.exists("starts", lambda s: F.slice(t, s + 1, F.size("words")) == F.col("words")))
    return both.where(found).select("query_id", "doc_id").distinct()


# ---- clause builder ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Word:
    term: str


@dataclass(frozen=True)
class Phrase:
    terms: tuple[str, ...]


@dataclass(frozen=True)
class And:
    left: object
    right: object


@dataclass(frozen=True)
class Or:
    left: object
    right: object


@dataclass(frozen=True)
class AndNot:
    left: object
    right: object


def phrase(*terms: str) -> Phrase:
    return Phrase(tuple(terms))


def leaf_terms(node) -> set[str]:
    if isinstance(node, Word):
        return {node.term}
    if isinstance(node, Phrase):
        return set(node.terms)
    return leaf_terms(node.left) | leaf_terms(node.right)


def _tf(m: Column, t: str) -> Column:
    return F.coalesce(F.size(m[F.lit(t)]), F.lit(0))


def _has(m: Column, t: str) -> Column:
    return F.coalesce(F.array_contains(F.map_keys(m), F.lit(t)), F.lit(False))


def compile_clause(node, m: Column) -> tuple[Column, Column]:
    """(matched, tf) expressions of a clause over a term -> positions map column ``m``.

    tf is the number of occurrences of the leaf terms in matched branches (an unmatched OR
    branch contributes nothing), which is what the positional tf sort ranks by.
    """
    if isinstance(node, Word):
        return _has(m, node.term), _tf(m, node.term)
    if isinstance(node, Phrase):
        ts = node.terms
        present = F.lit(True)
        for t in ts:
            present = present & _has(m, t)
        if len(ts) == 1:
            hit = present
        else:
            first = F.coalesce(m[F.lit(ts[0])], F.array().cast("array<int>"))

            def follows(p):
                ok = F.lit(True)
                for off, t in enumerate(ts[1:], start=1):
                    ok = ok & F.coalesce(F.array_contains(m[F.lit(t)], p + F.lit(off)), F.lit(False))
                return ok

            hit = present & F.exists(first, follows)
        tf = F.lit(0)
        for t in ts:
            tf = tf + _tf(m, t)
        return hit, tf
    lm, lt = compile_clause(node.left, m)
    rm, rt = compile_clause(node.right, m)
    if isinstance(node, And):
        return lm & rm, lt + rt
    if isinstance(node, Or):
        return lm | rm, F.when(lm, lt).otherwise(0) + F.when(rm, rt).otherwise(0)
    if isinstance(node, AndNot):
        return lm & ~rm, lt
    raise TypeError(node)


def bool_query(positional: DataFrame, clauses: dict[int, object]) -> DataFrame:
    """Evaluate clause trees, many at once: (query_id, doc_id, tf).

    ``positional``: (term, doc_id, positions). ``clauses``: query_id -> tree of Word / Phrase /
    And / Or / AndNot. Phrase terms must appear at consecutive positions in order.
    """
    spark = positional.sparkSession
    leaves = spark.createDataFrame(
        [(qid, t) for qid, node in clauses.items() for t in sorted(leaf_terms(node))], "query_id bigint, term string"
    )
    per_doc = (
        positional.join(leaves, "term")
        .groupBy("query_id", "doc_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("m"))
    )
    matched, tf = None, None
    for qid, node in clauses.items():
        mm, tt = compile_clause(node, F.col("m"))
        cond = F.col("query_id") == F.lit(qid)
        matched = F.when(cond, mm) if matched is None else matched.when(cond, mm)
        tf = F.when(cond, tt) if tf is None else tf.when(cond, tt)
    return per_doc.where(matched).select("query_id", "doc_id", tf.cast("bigint").alias("tf"))
