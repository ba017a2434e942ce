"""Index tables built from text columns.

Postings are kept one row per (term, document) and never collected per term: the commonest
terms occur in more than half of the documents, so a per-term list would put a third of the
data in one task. Every aggregation here is keyed by (doc_id, term) or uses partial
aggregation for per-term counts, so hot terms do not skew a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quarry.functions.text import Analyzer, tok_whitespace


def token_table(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = tok_whitespace) -> DataFrame:
    """(doc_id, pos, term), positions from 0. Null fields yield no tokens. No exchange."""
    return docs.select(F.col(id_col).alias("doc_id"), F.posexplode(analyzer(F.col(text_col))).alias("pos", "term"))


def run_starts(items, key=lambda x: x) -> Column:
    """Indexes at which a sorted array starts a run of equal keys."""
    before = lambda i: key(F.get(items, i - 1))
    at = F.sequence(F.lit(0), F.size(items) - 1)
    return F.when(F.size(items) > 0, F.filter(at, lambda i: (i == 0) | (key(F.get(items, i)) != before(i)))).otherwise(
        F.array().cast("array<int>")
    )


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, however often the body and the lambdas in it
    use it (a column would be copied into every use, also into those run per array element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(tokens: Column) -> Column:
    """Array of (term, tf) of a row's tokens, made within the row by sorting them."""

    def runs(s):
        def of(at):
            end = lambda i: F.coalesce(F.get(at, i + 1), F.size(s))
            return F.transform(at, lambda x, i: F.struct(F.get(s, x).alias("term"), (end(i) - x).cast("bigint").alias("tf")))

        return let(run_starts(s), of)

    return let(F.array_sort(tokens), runs)


def vocabulary_counts(docs: DataFrame, text_col: str, analyzer: Analyzer = tok_whitespace) -> DataFrame:
    """Collection frequency per term (partial aggregation before the shuffle)."""
    return (
        docs.select(F.explode(analyzer(F.col(text_col))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("cf"))
    )


def _only(tokens: Column, only: list[str] | None) -> Column:
    """The tokens that are among a few literal terms (all without ``only``)."""
    return tokens if only is None else F.filter(tokens, lambda x: x.isin(only))


def build_postings(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = tok_whitespace) -> DataFrame:
    """(term, doc_id), one row per distinct term of a document. No exchange."""
    return docs.where(F.col(text_col).isNotNull()).select(
        F.explode(F.array_distinct(analyzer(F.col(text_col)))).alias("term"), F.col(id_col).alias("doc_id")
    )


def build_keyword_index(docs: DataFrame, id_col: str, field: str) -> DataFrame:
    """Exact-value index over a nullable keyword field; nulls are skipped."""
    return docs.where(F.col(field).isNotNull()).select(F.col(field).alias("term"), F.col(id_col).alias("doc_id"))


def build_tf_postings(
    docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = tok_whitespace, only: list[str] | None = None
) -> DataFrame:
    """(term, doc_id, tf, doc_len); ``doc_len`` rides on every posting so ranking needs no join.
    A row holds a whole document, so its terms are counted within the row: no exchange. With ``only``,
    postings of those terms, taken from the row before it is unfolded."""
    counted = let(analyzer(F.col(text_col)), lambda t: F.transform(term_counts(_only(t, only)), lambda c: F.struct(c["term"].alias("term"), c["tf"].alias("tf"), F.size(t).alias("doc_len"))))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.explode(counted).alias("c"))
    return rows.select("c.term", "doc_id", "c.tf", "c.doc_len")


def matching_counts(docs: DataFrame, id_col: str, text_col: str, terms: DataFrame, analyzer: Analyzer = tok_whitespace) -> DataFrame:
    """(term, doc_id, tf, doc_len) of the terms of ``terms`` only, and per document one row of the
    term '' (no token is empty) that stands for the document itself, a null field having length 0.

    Terms are counted and filtered where the text is read; what is left moves once, by document.
    Statistics and scores read that one exchange (ReusedExchange), and sums per (query, document)
    need no other.
    """
    tokens = F.coalesce(analyzer(F.col(text_col)), F.array().cast("array<string>"))

    def rows_of(t):
        itself = F.array(F.struct(F.lit("").alias("term"), F.lit(1).cast("bigint").alias("tf")))
        return F.transform(F.concat(term_counts(t), itself), lambda c: F.struct(c["term"].alias("term"), c["tf"].alias("tf"), F.size(t).alias("doc_len")))

    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(let(tokens, rows_of)).alias("c"))
    wanted = terms.select("term").distinct().union(docs.sparkSession.createDataFrame([("",)], "term string"))
    return rows.select("c.term", "doc_id", "c.tf", "c.doc_len").join(wanted, "term").repartition("doc_id")


def matching_stats(matching: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(term, df) and one row (n_docs, avg_len) from ``matching_counts``.

    tf and doc_len stay in use and nothing is filtered, so that the exchange below is the one that
    the scores read."""
    held = (F.col("tf") > 0) & (F.col("doc_len") >= 0)
    per = matching.groupBy("term").agg(F.count(F.when(held, 1)).alias("df"), F.sum(F.col("doc_len").cast("double")).alias("len"))
    itself = F.col("term") == ""
    n, total = F.sum(F.when(itself, F.col("df"))), F.sum(F.when(itself, F.col("len")))
    return per.select("term", "df"), per.agg(n.alias("n_docs"), (total / n).alias("avg_len"))


def build_positional(
    docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = tok_whitespace, only: list[str] | None = None
) -> DataFrame:
    """(term, doc_id, positions ARRAY<INT> ascending), made within each document's row; with ``only``, of
    those terms."""

    def runs(s):
        def of(at):
            end = lambda i: F.coalesce(F.get(at, i + 1), F.size(s))
            run = lambda x, i: F.transform(F.slice(s, x + 1, end(i) - x), lambda y: y["pos"])
            return F.transform(at, lambda x, i: F.struct(F.get(s, x)["term"].alias("term"), run(x, i).alias("positions")))

        return let(run_starts(s, lambda x: x["term"]), of)

    pairs = F.transform(analyzer(F.col(text_col)), lambda t, i: F.struct(t.alias("term"), i.alias("pos")))
    pairs = F.array_sort(pairs if only is None else F.filter(pairs, lambda p: p["term"].isin(only)))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.explode(let(pairs, runs)).alias("p"))
    return rows.select("p.term", "doc_id", "p.positions")


def term_lookup(postings: DataFrame, term: str) -> DataFrame:
    """Postings of one term; an unknown term gives an empty frame."""
    return postings.where(F.col("term") == F.lit(term))


def term_df(postings: DataFrame) -> DataFrame:
    """Document frequency per term from postings (one row per (term, doc))."""
    return postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def doc_lengths(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = tok_whitespace) -> DataFrame:
    """(doc_id, len); a null field has length 0."""
    return docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.size(analyzer(F.col(text_col))), F.lit(0)).alias("len")
    ).withColumn("len", F.when(F.col("len") < 0, 0).otherwise(F.col("len")))


def corpus_stats(docs: DataFrame, id_col: str, text_col: str, analyzer: Analyzer = tok_whitespace) -> DataFrame:
    """One row: n_docs and avg_len (null fields count in N with length 0)."""
    lens = doc_lengths(docs, id_col, text_col, analyzer)
    return lens.agg(F.count(F.lit(1)).alias("n_docs"), F.avg(F.col("len").cast("double")).alias("avg_len"))


def dense_ids(df: DataFrame, order_col: str, out: str = "idx") -> DataFrame:
    """Consecutive 0-based integers in ``order_col`` order without a single-partition window.

    Range-partition and sort, then number rows inside each partition and add the running
    count of all earlier partitions. The partition-count table has one row per partition,
    so it is tiny and broadcast. The sorted input is checkpointed first so both passes see
    the same rows.
    """
    from quarry.operators.util import materialize

    sorted_df = df.repartitionByRange(F.col(order_col)).sortWithinPartitions(order_col)
    tagged = materialize(sorted_df.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id()))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = counts.withColumn(
        "_off", F.coalesce(F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )
    return (
        tagged.join(offsets.select("_pid", "_off", "_first"), "_pid")
        .withColumn(out, F.col("_off") + F.col("_mid") - F.col("_first"))
        .drop("_pid", "_mid", "_off", "_first")
    )


def stem_vocabulary(postings: DataFrame) -> DataFrame:
    """(term, stem) for the distinct vocabulary: the stemmer's expressions run once per distinct term, never
    once per token."""
    from quarry.functions.porter_sql import stems

    return stems(postings.select("term").distinct())


def stem_postings(postings: DataFrame) -> DataFrame:
    """Postings re-keyed by Porter stem: (term = stem, doc_id, tf summed over merged terms)."""
    from quarry.operators.util import materialize

    vocab = materialize(stem_vocabulary(postings))  # the join then reads plain shuffles, which AQE splits at a hot term
    return (
        postings.join(vocab, "term")
        .groupBy(F.col("stem").alias("term"), "doc_id")
        .agg(F.sum("tf").alias("tf"))
    )
