"""Parsed results that are kept: only inputs that are new or changed are parsed again.

A store is a folder.  Each run adds the rows that it parsed below ``rows`` and
then a manifest below ``manifest``, which names for every input its stamp and the
run that parsed it.  A manifest counts once Spark has committed it; what a broken
run left is not named by any manifest and never read.  Runs on one store follow
one another.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def _runs(spark: SparkSession, store: str) -> list[int]:
    """Numbers of the committed manifests."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{store}/manifest")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [str(x.getPath()) for x in files.listStatus(root)] if files.exists(root) else []
    named = [(m, p) for p in found if (m := re.search(r"/run=(\d+)$", p))]
    return sorted(int(m[1]) for m, p in named if files.exists(jvm.org.apache.hadoop.fs.Path(f"{p}/_SUCCESS")))


def reused(inputs: DataFrame, key: str, stamp: list[str], parse: Callable[[DataFrame], DataFrame], store: str, version: str = "1") -> tuple[DataFrame, int]:
    """Parsed rows of all ``inputs``, each with ``run`` (that parsed it), and how many inputs this run parsed.

    ``stamp`` names columns that change when an input does: a digest of its
    content, or length and time of a file.  ``parse`` maps rows of ``inputs`` to
    rows that have ``key``.  ``version`` is that of the parser: another one parses
    all again.  The key is unique and not null; inputs that are gone leave the result.
    """
    spark = inputs.sparkSession
    done = _runs(spark, store)
    run = done[-1] + 1 if done else 0
    mark = F.sha2(F.to_json(F.struct(F.lit(version).alias("version"), *stamp)), 256)
    now = inputs.withColumn("_mark", mark)
    if done:
        known = spark.read.parquet(f"{store}/manifest/run={done[-1]}").withColumnRenamed("key", key)
        same = now.select(key, "_mark").join(known.withColumnRenamed("mark", "_mark"), [key, "_mark"])
        fresh = now.join(known.select(key, F.col("mark").alias("_mark")), [key, "_mark"], "left_anti")
    else:
        same, fresh = None, now
    seen = Observation()
    rows = parse(fresh.observe(seen, F.count(F.lit(1)).alias("n")).drop("_mark"))
    rows.write.mode("overwrite").parquet(f"{store}/rows/run={run}")
    manifest = fresh.select(F.col(key).alias("key"), F.col("_mark").alias("mark"), F.lit(run).alias("run"))
    if same is not None:
        manifest = same.select(F.col(key).alias("key"), F.col("_mark").alias("mark"), "run").unionByName(manifest)
    manifest.write.mode("overwrite").parquet(f"{store}/manifest/run={run}")
    return kept(spark, key, store, rows.schema), seen.get["n"]


def kept(spark: SparkSession, key: str, store: str, schema) -> DataFrame:
    """The rows that the last committed manifest names."""
    last = _runs(spark, store)[-1]
    named = spark.read.parquet(f"{store}/manifest/run={last}").select(F.col("key").alias(key), "run")
    rows = spark.read.schema(schema).option("basePath", f"{store}/rows").parquet(f"{store}/rows")
    return rows.join(named, [key, "run"], "left_semi")


def file_stamps(spark: SparkSession, path: str, ending: str = "*") -> DataFrame:
    """path, length, time of every file of a tree; no file is read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", ending).load(path)
    return f.select("path", "length", F.unix_micros("modificationTime").alias("time"))


def opened(files: DataFrame) -> DataFrame:
    """path and content of the files named by ``path``, read where the rows are: files that are not named are not read."""

    def read(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                at, name = fs.FileSystem.from_uri(path)
                with at.open_input_file(name) as f:
                    yield pa.RecordBatch.from_arrays([pa.array([path], pa.string()), pa.array([f.read()], pa.binary())], ["path", "content"])

    return files.select("path").repartition("path").mapInArrow(read, "path string, content binary")
