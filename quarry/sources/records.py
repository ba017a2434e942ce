"""JSON records in and out, and persisted index tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import term_bucket

RECORD_ARRAY = "array<struct<doc_id:string,title:string>>"


def export_json(df: DataFrame, cols: list[str], out: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct(*[F.col(c) for c in cols])).alias(out))


def write_json(df: DataFrame, path: str) -> None:
    """Rows as JSON lines, as many files as the rows have tasks; null fields are written as null."""
    df.write.option("ignoreNullFields", "false").json(path)


def read_json(spark, path: str, schema) -> DataFrame:
    """JSON lines with a stated schema, so that nothing is read to infer one; a line that is no record of it
    fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def save_index(postings: DataFrame, path: str, buckets: int = 64) -> None:
    """Write postings as Parquet partitioned by a term bucket, so a term lookup reads one folder. The
    rebalance lets AQE size the tasks: a hot term's bucket is several files, small buckets share one task."""
    (
        postings.withColumn("term_bucket", term_bucket(F.col("term"), buckets))
        .hint("rebalance", "term_bucket")
        .sortWithinPartitions("term_bucket", "term", "doc_id")
        .write.mode("overwrite")
        .partitionBy("term_bucket")
        .parquet(path)
    )


def load_index(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def lookup_saved(index: DataFrame, term: str, buckets: int = 64) -> DataFrame:
    """Term lookup with the partition predicate added explicitly (Catalyst cannot derive it)."""
    return index.where((F.col("term_bucket") == term_bucket(F.lit(term), buckets)) & (F.col("term") == term))
