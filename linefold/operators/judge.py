"""Rows decided by an injected function, such as a model call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def judged(df: DataFrame, text: str, judge: Callable[[str], bool], asked: Column) -> DataFrame:
    """Append ``status``: not asked, accepted, rejected or failed (the call raised).

    ``asked`` is evaluated before the Python step, so rows that it rules out cost no call.
    """
    schema = df.drop("status").schema.add("status", "string")

    def ask(value: str) -> str:
        try:
            return "accepted" if judge(value) else "rejected"
        except Exception:  # the caller's function may fail in any way; such rows are reported
            return "failed"

    def run(frames):
        for f in frames:
            yield f.assign(status=[ask(v) for v in f[text]])

    df = df.drop("status").withColumn("_asked", F.coalesce(asked, F.lit(False)))
    rest = df.where("not _asked").drop("_asked").withColumn("status", F.lit("not asked"))
    return df.where("_asked").drop("_asked").mapInPandas(run, schema).unionByName(rest)


def answers(df: DataFrame, answer: str) -> DataFrame:
    """Explode a model's JSON answer, ``[{"page": .., "text": ..}, ..]``, into rows.

    A fence around the answer is taken off; an answer that does not parse is
    tried again with its lone back-slashes doubled; what still fails gives no row.
    """
    kind = "array<struct<page: int, text: string>>"
    bare = F.regexp_replace(F.regexp_replace(answer, r"(?s)^\s*```[a-z]*\s*", ""), r"(?s)\s*```\s*$", "")
    repaired = F.regexp_replace(bare, r'\\(?!["\\/bfnrtu])', r"\\\\")
    parsed = F.when(F.try_parse_json(bare).isNotNull(), F.from_json(bare, kind)).otherwise(F.from_json(repaired, kind))
    return df.select(*[c for c in df.columns if c != answer], F.explode(parsed).alias("p")).select(*[c for c in df.columns if c != answer], "p.page", "p.text")
