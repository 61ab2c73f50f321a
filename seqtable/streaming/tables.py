"""Streams of summaries and status logs."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.metadata import upsert
from ..plans.stages import staged, unstage


#: Parts of a keyed table; a batch rewrites only those that its keys fall into.
BUCKETS = 64
#: Batches whose tables can be read later.
KEPT = 10
#: Names of the folders of versions and parts, which no column of the table may have.
VERSION, PART = "seqtable_version", "seqtable_part"


def stream_upsert(stream: DataFrame, target_path: str, keys: list[str], checkpoint: str, order: list[str] | None = None, buckets: int = BUCKETS, keep: int = KEPT) -> StreamingQuery:
    """Put each batch of a stream into a keyed table of versioned parts; a batch that is replayed writes the same again.

    Batch n writes version n of the parts that its keys fall into, each from the part's latest version before n; other
    parts keep theirs. :func:`latest` reads, of each part, the last version up to a batch that is done. Versions that
    newer ones took the place of more than ``keep`` (at least 1) batches ago are removed, so that a part has at most
    ``keep + 1`` however long the stream is, and the tables after the last ``keep`` batches can be read.
    """
    if keep < 1:
        raise ValueError("a batch that is replayed needs the versions before it: keep at least 1")

    def put(batch: DataFrame, n: int) -> None:
        part = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")
        new = staged(batch.withColumn(PART, part))
        touched = [r[PART] for r in new.select(PART).distinct().collect()]  # at most ``buckets`` numbers
        empty = batch.limit(0).select(*[F.col(c).cast("string").alias(c) for c in batch.columns])
        old = latest(batch.sparkSession, target_path, n - 1, touched) if n else None
        old = empty if old is None else old.select(*empty.columns)
        both = upsert(old, new.drop(PART), keys, order)
        both.withColumn(PART, part).write.mode("overwrite").partitionBy(PART).parquet(f"{target_path}/{VERSION}={n}")
        unstage(new)
        remove_superseded(batch.sparkSession, target_path, n - keep)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def remove_superseded(spark: SparkSession, target_path: str, done: int) -> None:
    """Delete the versions of parts that a newer version of ``done`` or before has taken the place of."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{target_path}/{VERSION}=*/{PART}=*")
    fs = path.getFileSystem(conf)
    parts: dict[str, list[tuple[int, object]]] = {}
    for found in fs.globStatus(path) or []:  # a few folders for each part, since older ones are gone
        at = found.getPath()
        version = int(at.getParent().getName().split("=")[1])
        if version <= done:
            parts.setdefault(at.getName(), []).append((version, at))
    last = {part: max(v for v, _ in versions) for part, versions in parts.items()}
    for part, versions in parts.items():
        for version, at in versions:
            if version < last[part]:
                fs.delete(at, True)
    for found in fs.globStatus(path.getParent()) or []:  # versions without parts go whole
        version = int(found.getPath().getName().split("=")[1])
        if version <= done and version not in last.values():
            fs.delete(found.getPath(), True)


def latest(spark: SparkSession, target_path: str, done: int, parts: list[int] | None = None) -> DataFrame | None:
    """The table after batch ``done`` (or some parts of it): of each part its last version; None before the first batch."""
    try:
        rows = spark.read.parquet(target_path).where(F.col(VERSION) <= done)
    except AnalysisException:  # nothing is written yet
        return None
    rows = rows if parts is None else rows.where(F.col(PART).isin(parts))
    last = rows.groupBy(F.col(PART).alias("_p")).agg(F.max(VERSION).alias("_v"))  # one row for each part
    return rows.join(F.broadcast(last), (F.col(PART) == F.col("_p")) & (F.col(VERSION) == F.col("_v"))).drop("_p", "_v", PART, VERSION)


def stream_tally(stream: DataFrame) -> DataFrame:
    """Running (run_id, status, n); for output mode update or complete. A run's counts are final when the run is."""
    return stream.groupBy("run_id", "status").agg(F.count("*").alias("n"))
