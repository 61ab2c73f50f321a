"""Stage tables: written once in the shared folder and read back, so that loops keep short plans and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: The stage tables of the innermost open scope.
_made: ContextVar[list[DataFrame] | None] = ContextVar("_made", default=None)


def stage_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session may leave that unset, as in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-seqtable-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """``df`` as a written table below ``spark.checkpoint.dir``."""
    path = stage_folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_to = path
    if (made := _made.get()) is not None:
        made.append(out)
    return out


@contextmanager
def scope() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Stage tables made inside are deleted at the end, also after an error; what goes through the given function is written
    and stays. It then belongs to the scope outside, if there is one."""
    token = _made.set(own := [])

    def keep(df: DataFrame) -> DataFrame:
        out = staged(df)
        kept.append(own.pop())
        return out

    kept: list[DataFrame] = []
    try:
        yield keep
    except BaseException:
        own += kept
        raise
    finally:
        _made.reset(token)
        unstage(*own)
        if (outer := _made.get()) is not None:
            outer += kept


def unstage(*tables: DataFrame) -> None:
    """Delete the files of tables that ``staged`` made, once all that was read from them is written itself."""
    for t in tables:
        jvm = t.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.staged_to)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
