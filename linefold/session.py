"""Shared folders of a session."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; only a local session without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="linefold-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{label}-{uuid.uuid4().hex}"


#: File system and path of the tables that this driver has written and not removed.
_LEFT: dict[str, tuple] = {}


def remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    _LEFT.pop(path, None)


@atexit.register
def _tidy() -> None:
    """When the driver ends, what ``written`` has left is removed; a driver that is killed leaves it."""
    for files, at in _LEFT.values():
        with contextlib.suppress(Py4JError, OSError):
            files.delete(at, True)
    _LEFT.clear()


def written_at(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared folder and read it back: later steps start from files that outlive executors.  Also its path.

    The table lasts as long as the driver, or until ``remove``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _LEFT[path] = (at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at)
    return spark.read.schema(df.schema).parquet(path), path


def written(df: DataFrame, label: str) -> DataFrame:
    return written_at(df, label)[0]


class Workspace:
    """A shared folder for the tables of one step, removed with all of them when the step is over.

    What the step returns must not read from it any more.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.path, self.tables = spark, shared_dir(spark, label), 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        remove(self.spark, self.path)

    def written(self, df: DataFrame, label: str, tasks: int | None = None) -> DataFrame:
        """As ``written``; by at most ``tasks`` tasks."""
        return self.counted(df, label, tasks)[0]

    def counted(self, df: DataFrame, label: str, tasks: int | None = None) -> tuple[DataFrame, int]:
        """The written table and its number of rows, which is taken along while writing."""
        self.tables += 1
        path, seen = f"{self.path}/{label}-{self.tables}", Observation()
        schema = df.schema
        df = df.observe(seen, F.count(F.lit(1)).alias("n"))
        (df.coalesce(tasks) if tasks else df).write.parquet(path)
        return self.spark.read.schema(schema).parquet(path), seen.get["n"]
