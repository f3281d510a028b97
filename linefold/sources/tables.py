"""Readers of the driver tables and of the views that stand for the engine's own inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same lines in SQL: a document's text split at line ends.
LINES_SQL = """lines AS (
    SELECT doc_id, i AS idx, parts[i] AS text
    FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), unnest(range(1, len(parts) + 1)) AS u(i))"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, idx (from 1), text of each line of each document."""
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "text")).select("doc_id", (F.col("pos") + 1).cast("long").alias("idx"), "text")
