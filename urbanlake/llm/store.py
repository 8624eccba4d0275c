"""Tables that cut lineage, in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a table of ids that may be broadcast: 8 MB of ids at most.
BROADCAST_ROWS = 1 << 20
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@cache
def _local() -> str:
    return "file://" + tempfile.mkdtemp(prefix="spark-")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which all machines must share; one is made where driver and executors are one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = _local()
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: later reads survive lost executors."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete folders of the shared store."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def drop(*tables: DataFrame) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, *{f.rpartition("/")[0] for f in df.inputFiles()})


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[str]]:
    """Tables that are written inside go at the end, but for those taken out of the list that this gives."""
    token = _made.set([])
    try:
        yield _made.get()
    finally:
        remove(spark, *_made.get())
        _made.reset(token)


def semi(df: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is (with ``left_anti``: isn't) in the written table ``ids``: broadcast where it has at most ``BROADCAST_ROWS`` rows, else shuffled."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, key, how)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Keep Arrow batches of long texts small; a smaller setting of the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def crc_part(column, modulus: int):
    """crc32 of a key as text, modulo ``modulus`` (null for a null key)."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
