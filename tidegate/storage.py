"""Where intermediate tables go.

Intermediate results that several later steps read are written as Parquet under the
shared folder the session names in ``spark.checkpoint.dir``, so they survive the loss
of executors and give the optimizer real sizes to decide on. ``Scratch`` holds those of one
call and deletes them when the call has written its result.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
#: Writer options of tables that stay: compressed more than those of one call.
COMPACT = {"compression": "zstd"}
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder; a temporary one only for a local session that names none."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tidegate-")
    return _local_folders[app]


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_dir(spark)}/tidegate/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    return _written(df, new_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of a file system that Spark reaches."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of a file system that Spark reaches is there."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every query run in the block go when it ends; for steps whose results are written tables."""
    before = spark.conf.get(_FREE, "false")
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE, before)


class Scratch:
    """Intermediate tables of one call: ``with Scratch(spark) as scratch: ...``.

    What ``materialise`` gives is gone after the block, so only tables written elsewhere
    may leave it.
    """

    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark, self.path = spark, new_path(spark, name)

    def materialise(self, df: DataFrame, name: str) -> DataFrame:
        return _written(df, f"{self.path}/{name}-{uuid.uuid4().hex}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.path)


def spread(df: DataFrame) -> DataFrame:
    """Give a table of one file, read whole by one task, one partition per core.

    Heavy per-row work on it would otherwise run in that task. Tables of several files are
    left where they are.
    """
    spark = df.sparkSession
    return df.repartition(spark.sparkContext.defaultParallelism) if len(df.inputFiles()) == 1 else df
