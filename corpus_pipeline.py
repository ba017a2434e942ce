"""The corpus pipeline: toxicity, line dedup, near-dedup, decontamination, packing.

Each stage takes what its predecessor kept. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, linededup, minhash, packing, toxicity
from quarry.llm.common import read, ready, written

COLUMNS = ("text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones among them, does not reject."""
    ready(spark)
    model = toxicity.fit(toxicity.labelled_rows(docs, read(spark, sf_dir, "labels"), "doc_id", "text", "toxic"))
    scored = toxicity.score(docs, model, "doc_id", "text", carry=COLUMNS)
    return scored.where("predicted = 0").select("doc_id", *COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines they share with an earlier one; a document that loses
    all its lines goes."""
    ready(spark)
    out = linededup.dedup_lines(docs.select("doc_id", *COLUMNS), "doc_id", "text")
    changed = F.size("removed_lines") > 0
    out = out.where(~(changed & (F.trim("text") == "")))
    return out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select("doc_id", *COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    ready(spark, "4m")  # pairs of texts share a batch
    return minhash.deduplicate(docs.select("doc_id", *COLUMNS), "doc_id", "text", minhash.Params(words=5))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ready(spark)
    return decontaminate.clean(docs.select("doc_id", *COLUMNS), "text", read(spark, sf_dir, "benchmark"), "item_id", "text")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces with their token ids."""
    import public_tokenizers

    ready(spark)
    return packing.pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("minhash", dedup_near),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
ORACLE_SQL = None  # trained, aligned and tokenized stages have no SQL; tests/llm compares them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every stage is written and read again."""
    ready(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
