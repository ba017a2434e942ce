"""Stream an operation log into an append-only Parquet table, one micro-batch per trigger.

Each micro-batch is written under ``batch=<batchId>`` with overwrite, so a batch replayed
after a failure replaces its own output instead of duplicating it (idempotent sink). The
checkpoint lives under the shared ``spark.checkpoint.dir``, and a later run resumes from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path


def stream_log_to_table(
    spark: SparkSession,
    source_dir: str,
    file_glob: str,
    schema,
    to_log,
    table: str | None = None,
    checkpoint: str | None = None,
    max_bytes: int = 256 << 20,
) -> tuple[str, int]:
    """Run the stream over what has arrived (availableNow); return (table path, batches run).

    ``to_log`` turns a micro-batch into log rows, which say themselves which commit they belong to, so the
    log does not depend on how files fall into batches. Batches hold about ``max_bytes`` of files. With a
    ``table`` and ``checkpoint`` of an earlier run the stream goes on where that one ended; a batch that
    failed midway is run again under its number and replaces what it left.
    """
    out = table or scratch_path(spark, "corpus-log")
    ckpt = checkpoint or scratch_path(spark, "corpus-log-ckpt")
    seen = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        to_log(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file_glob)
        .option("maxBytesPerTrigger", max_bytes)
        .parquet(source_dir)
    )
    q = stream.writeStream.foreachBatch(handle).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return out, len(seen)


def read_log(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path).drop("batch") if schema is not None else spark.read.parquet(path).drop("batch")
