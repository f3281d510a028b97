"""Writers of results: JSON detail, appended JSON history, CSV for spreadsheets, HTML rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_history(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def last_of_tag(spark: SparkSession, path: str, schema: str, tag: str, by: str) -> DataFrame:
    """The last record of each tag; lines that do not parse are left out."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    rest = [c for c in rows.columns if c not in (tag, by)]
    return rows.where(F.col(tag).isNotNull()).groupBy(tag).agg(F.max(F.struct(by, *rest)).alias("x")).select(tag, "x.*")


def write_csv(df: DataFrame, path: str) -> None:
    """With a header, which begins with a byte order mark so that spreadsheets read it as UTF-8."""
    first = df.columns[0]
    df.withColumnRenamed(first, "﻿" + first).write.mode("overwrite").option("header", True).csv(path)


def escaped(c) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(F.col(c) if isinstance(c, str) else c, F.lit(a), F.lit(b))
    return c
