"""Tables written in the shared folder of the cluster, to cut lineage and to read a costly result twice."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a local session without one gets a folder of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="tianguis-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Paths that have been given out while they were recorded.
_RECORDED: list[str] = []
_recording = False


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing has used before."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _recording:
        _RECORDED.append(path)
    return path


@contextmanager
def dropped_before(df: DataFrame) -> Iterator[None]:
    """Record the paths given out inside; those recorded earlier are dropped first, unless `df` still reads one of them.

    For stages whose results are written before the next begins: what one has staged goes when the next starts.
    """
    global _recording
    read = df.inputFiles()
    if not any(path.partition("://")[2] in file for path in _RECORDED for file in read):
        while _RECORDED:
            remove(df.sparkSession, _RECORDED.pop())
    _recording = True
    try:
        yield
    finally:
        _recording = False


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it again.

    A lost executor repeats only its own tasks of the write; what is read afterwards no longer depends on them.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one run, each dropped when what was made of it has been staged."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, new_path(spark, name)

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        """Like `staged`; shuffle files of the job that wrote the table go with it.

        Spark drops those when the driver happens to collect its garbage, which a driver with little to do does late.
        """
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, f"{self.folder}/{name}")
