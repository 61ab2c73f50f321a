"""Shared working space for operators that cut lineage or read an intermediate twice."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    Only a local session, whose driver is its one executor, may leave the setting out: it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-seqtable-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/seqtable-{uuid.uuid4().hex}"


def written(df: DataFrame, compression: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: no recomputation, and nothing is lost with an executor."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables that ``written`` made, once all that was read from them is written itself."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def least_hashed(df: DataFrame, key: Column, n: int) -> DataFrame:
    """At most ``n`` rows, those with the least values of ``key``, a 64-bit hash: a sample that does not depend on partitions.

    Rows far above the expected n-th value are filtered where they stand, so that tasks send about ``n`` rows in all.
    """
    total = df.count()
    kept = df.withColumn("_key", key)
    if total > 2 * n:
        kept = kept.where(F.col("_key") < int(-(2**63) + 2**64 * min(1.0, (n + 8 * n**0.5 + 64) / total)))
    return kept.orderBy("_key").limit(n).drop("_key")


def small_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Arrow batches of few bytes, since single texts may be megabytes long; rows are bounded by Spark's own setting."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))
