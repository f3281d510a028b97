"""Checks as tables of violations: each check is a DataFrame (check, key), all checks are their union."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_check(df: DataFrame, name: str, key: str, broken: Column) -> DataFrame:
    return df.where(F.coalesce(broken, F.lit(False))).select(F.lit(name).alias("check"), F.col(key).cast("string").alias("key"))


def unique_check(df: DataFrame, name: str, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1").select(F.lit(name).alias("check"), F.col(key).cast("string").alias("key"))


def reference_check(df: DataFrame, name: str, key: str, defined: DataFrame, defined_key: str) -> DataFrame:
    used = df.select(F.col(key).alias(defined_key)).distinct()
    return used.join(defined.select(defined_key).distinct(), defined_key, "left_anti").select(F.lit(name).alias("check"), F.col(defined_key).cast("string").alias("key"))


def all_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)
