"""Tables written between steps, in the folder that the driver and the executors share.

A written table ends a lineage: a lost executor then costs a read, not a recomputation, and steps that
read it twice compute it once. A session has one folder for them, which goes when the driver ends; a table
goes before that where a step tells that nobody reads it any more.
"""

from __future__ import annotations

import atexit
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Shuffle files of a finished execution are of no more use to a table that is written.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and the executors share: spark.checkpoint.dir.

    Where that is unset, a session on one machine takes a temporary folder; one on a cluster is refused, as every
    machine would write to a disk of its own.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-checkpoint-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at a path of any file system that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if there is one."""
    _delete(spark, path)


def _forget(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may have ended before the driver does
        _delete(spark, path)


def session_dir(spark: SparkSession) -> str:
    """This session's own folder below the shared one."""
    key = spark.sparkContext.applicationId
    base = shared_dir(spark)
    if not _folders.get(key, "").startswith(base + "/"):
        _folders[key] = f"{base}/winnow-{key}-{uuid.uuid4().hex[:8]}"
        atexit.register(_forget, spark, _folders[key])
    return _folders[key]


_lock = threading.Lock()
#: Of each session, the writes under way and the setting before the first of them.
_writing: dict[str, tuple[int, str]] = {}


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """The setting holds as long as any thread of the session writes, and is then as it was."""
    key = spark._jsparkSession.sessionUUID()
    with _lock:
        n, before = _writing.get(key) or (0, spark.conf.get(_CLEANUP, "false"))
        _writing[key] = n + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            n, before = _writing.pop(key)
            if n > 1:
                _writing[key] = n - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the session's folder that nothing was written to."""
    return f"{session_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """df, written as a Parquet table and read again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with dropping_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote, once no DataFrame still to be run reads them."""
    for df in tables:
        _delete(df.sparkSession, df.cut_path)


#: Times its even share of the rows that a task may read before a table is dealt again: dealing moves all of it, so a slight lean is left as it is.
LEAN = 1.6


def spread(df: DataFrame) -> DataFrame:
    """A table as it is read, over as many tasks as there are cores at least: a row group is else read, and all that follows computed, by one task.

    A file is parted by its size, however few row groups it has: of many tasks, one may then read all rows. So rows are counted by task, of which the files' footers tell.
    """
    cores, n = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if n < cores:
        return df.repartition(cores)
    by_task = df.groupBy(F.spark_partition_id().alias("task")).count()
    most, total = by_task.agg(F.max("count"), F.sum("count")).first()
    # by the rows' numbers: repartition(n) alone would first sort what a task reads, texts and all
    return df.repartition(n, F.monotonically_increasing_id()) if total and most * cores > LEAN * total else df
