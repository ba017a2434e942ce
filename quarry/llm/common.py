"""Helpers shared by the operators: table reads, written intermediate tables, skew-free ranks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import ensure_checkpoint_dir, scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the shared ``spark.checkpoint.dir`` and read it
    back. Committed files survive lost executors, and whatever was decided while writing (row
    numbers, partition ids) is frozen."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch = path  # type: ignore[attr-defined]
    return out


def drop_written(df: DataFrame) -> None:
    """Delete a table made by ``written`` that nothing reads any more."""
    path = getattr(df, "scratch", None)
    if path:
        jvm = df.sparkSession._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def utf8(c: str | Column) -> Column:
    """UTF-8 bytes of a string column; null becomes empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def held_out(id_col: str, mod: int, rest: int) -> Column:
    """crc32(id as text) mod ``mod`` = ``rest``; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % mod == rest, F.lit(False))


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a unique long ``_row`` (writing partition << 33 | position)."""
    return written(df.withColumn("_row", F.monotonically_increasing_id()), name)


def ordinals(rows: DataFrame, group: str, out: str) -> DataFrame:
    """Gapless 0-based position ``out`` of each row of a ``numbered`` table within ``group``.

    A group's rows are ranked per writing partition and shifted by the counts of earlier
    partitions, so no task ever holds more of a group than one partition wrote.
    """
    pid = F.shiftright("_row", 33)
    rows = rows.withColumn("_pid", pid)
    counts = rows.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_g"), F.col("_pid").alias("_p"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    local = F.row_number().over(Window.partitionBy(group, "_pid").orderBy("_row")) - 1
    ranked = rows.withColumn("_local", local)
    return (
        ranked.join(offsets, (F.col(group).eqNullSafe(F.col("_g"))) & (F.col("_pid") == F.col("_p")))
        .withColumn(out, (F.col("_before") + F.col("_local")).cast("long"))
        .drop("_g", "_p", "_pid", "_before", "_local")
    )


def ready(spark: SparkSession, batch: str = "16m") -> None:
    """What the queries expect of a session: a checkpoint folder, and Arrow batches of at most
    ``batch``, so that a task's Python side holds little whatever the texts' lengths."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch)


def trim() -> None:
    """Give what this worker has freed back to the system: workers outlive their tasks, and the memory of
    finished stages would count against the next one's."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    free = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if free:
        free(0)
