"""Join-strategy and lineage helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def one_row(df: DataFrame) -> DataFrame:
    """Mark a global aggregate (exactly one row by construction) for broadcast."""
    return F.broadcast(df)


def materialize(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared ``spark.checkpoint.dir``."""
    from quarry.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back."""
    from quarry.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_path = path  # type: ignore[attr-defined]
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table made by ``stored`` that nothing reads any more."""
    path = getattr(df, "stored_path", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
