"""Typed readers for the corpus tables and the derived tables the experiments use.

Every reader passes an explicit schema (no inference) and returns a lazy DataFrame, so column
pruning and filters reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.text import tok_whitespace

SCHEMAS: dict[str, T.StructType] = {
    "documents": T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("text", T.StringType()),
            T.StructField("lang", T.StringType()),
            T.StructField("source", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    ),
    "labels": T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("quality", T.IntegerType()), T.StructField("toxic", T.IntegerType())]
    ),
    "part": T.StructType(
        [
            T.StructField("p_partkey", T.LongType()),
            T.StructField("p_name", T.StringType()),
            T.StructField("p_brand", T.StringType()),
            T.StructField("p_type", T.StringType()),
            T.StructField("p_size", T.IntegerType()),
            T.StructField("p_retailprice", T.DoubleType()),
        ]
    ),
    "benchmark": T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())]),
    "conversations": T.StructType(
        [
            T.StructField("conv_id", T.LongType()),
            T.StructField("turn", T.LongType()),
            T.StructField("role", T.StringType()),
            T.StructField("text", T.StringType()),
        ]
    ),
    "embeddings": T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            T.StructField("label", T.IntegerType()),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
    "pages": T.StructType(
        [T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())]
    ),
}


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt over ``spark.quarry.scan.partitions`` tasks if the deployment sets that, for inputs
    of a few huge row groups; by default a scan keeps its own splits."""
    n = df.sparkSession.conf.get("spark.quarry.scan.partitions", None)
    return df.repartition(int(n)) if n else df


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = SCHEMAS.get(name)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


# ---------------------------------------------------------------------------------------------
# Derived tables (each is a pure function of the given tables, so it grows with them)
# ---------------------------------------------------------------------------------------------

def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query set (query_id, term, qpos): all tokens of each benchmark item."""
    b = read_table(spark, sf_dir, "benchmark")
    return b.select(F.col("item_id").alias("query_id"), F.posexplode(tok_whitespace(F.col("text"))).alias("qpos", "term"))


def literal_queries(spark: SparkSession, queries: dict[int, list[str]]) -> DataFrame:
    rows = [(qid, pos, t) for qid, terms in queries.items() for pos, t in enumerate(terms)]
    return spark.createDataFrame(rows, "query_id bigint, qpos int, term string")


def judgments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged pairs (query_id, query, doc_id, label, split, title, description).

    query_id = the number in ``documents.source`` (documents without one are judged for nothing),
    query = the benchmark item of that id; label from (quality, toxic): (1,0) E, (1,1) S, (0,0) C,
    (0,1) I; split = test when query_id % 5 = 0, else train; title and description = the text.
    """
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    labels = read_table(spark, sf_dir, "labels")
    queries = read_table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    qid = F.regexp_extract(F.col("source"), "(\\d+)", 1).try_cast("bigint")
    label = (
        F.when((F.col("quality") == 1) & (F.col("toxic") == 0), "E")
        .when((F.col("quality") == 1) & (F.col("toxic") == 1), "S")
        .when((F.col("quality") == 0) & (F.col("toxic") == 0), "C")
        .otherwise("I")
    )
    # one row per query: left to AQE, which broadcasts it after measuring it at run time
    pairs = labels.join(docs.withColumn("query_id", qid), "doc_id").join(queries, "query_id")
    return pairs.select(
        "query_id",
        "query",
        "doc_id",
        label.alias("label"),
        F.when(F.col("query_id") % 5 == 0, "test").otherwise("train").alias("split"),
        F.col("text").alias("title"),
        F.col("text").alias("description"),
    )


LOG_SCHEMA = "commit_id bigint, doc_id bigint, op string, title string, seq bigint"


def events_to_log(ev: DataFrame) -> DataFrame:
    """Operation log from the events table: key user_id, commit = day of ts, seq = event_id
    (event ids increase with ts); ``error`` deletes, every other type upserts a title made of
    the event type repeated k % 3 + 1 times (k from the JSON props)."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    title = F.array_join(F.array_repeat(F.col("event_type"), (k % 3 + 1).cast("int")), " ")
    return ev.select(
        F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("bigint").alias("commit_id"),
        F.col("user_id").alias("doc_id"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
        F.when(F.col("event_type") != "error", title).alias("title"),
        F.col("event_id").alias("seq"),
    )


def events_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_log(read_table(spark, sf_dir, "events"))


def documents_load_log(spark: SparkSession, sf_dir: str, passes: int = 2, batches: int = 100) -> DataFrame:
    """The corpus loaded twice in ~100 commits each: commit = pass * batches + md5(doc_id) % batches."""
    from quarry.functions.hashing import md5_mod

    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    p = F.explode(F.sequence(F.lit(0), F.lit(passes - 1))).alias("pass")
    return docs.select("doc_id", "text", p).select(
        (F.col("pass") * batches + md5_mod("doc_id", batches)).cast("bigint").alias("commit_id"),
        "doc_id",
        F.lit("upsert").alias("op"),
        F.col("text").alias("title"),
        F.col("doc_id").alias("seq"),
    )


def judgments_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judged pairs written once to the shared checkpoint folder, for plans that read them
    several times (systems, ideal ranking, features)."""
    from quarry.operators.util import materialize

    return materialize(judgments(spark, sf_dir))
