"""Corpus pipeline: each stage applies one operator to what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.llm import bpe, decontaminate, language_id, near_dedup, secret_scan
from linefold.llm.common import read
from linefold.llm.queries import PATTERN, VOCABULARY
from linefold.session import remove, written_at


def _apart(docs: DataFrame) -> DataFrame:
    """The columns that no operator reads under names that no operator writes."""
    return docs.select(*[F.col(f"`{c}`") if c in ("doc_id", "lang", "text") else F.col(f"`{c}`").alias(f"in_{k}") for k, c in enumerate(docs.columns)])


def _back(made: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again; n_chars follows the text."""
    cols = [F.col(c if c in ("doc_id", "lang", "text") else f"in_{k}").alias(c) for k, c in enumerate(docs.columns)]
    out = made.select(*cols)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language (``und``)."""
    found = language_id.identify(_apart(docs), language_id.fit(docs))
    return _back(found.where("lang_pred != 'und'"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id.  Repeated rows of an id are one document: one row stays.

    Of rows with an id it is one of the set that was compared, the first by text and then by all columns.  All rows without an id stay.
    """
    groups = near_dedup.near_duplicates(docs)
    left = docs.join(groups.where("not kept").select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
    again = left.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.take(1):
        return left
    cols = [F.col(f"`{c}`") for c in docs.columns]
    rows = near_dedup.digested(left.join(again, "doc_id", "left_semi").select(F.struct(*cols).alias("row"), "doc_id", "text"))
    first = F.struct(F.col("digest").isNull(), "digest", "text", F.to_json("row"))
    one = rows.groupBy("doc_id").agg(F.min_by("row", first).alias("row")).select("row.*")
    return left.join(again, "doc_id", "left_anti").select(*docs.columns).unionByName(one)


def decontaminate_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops contaminated documents; cuts the hit words out of the others."""
    blocks = decontaminate.blocks_of(read(spark, sf_dir, "benchmark"))
    return _back(decontaminate.clean(_apart(docs), blocks), docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret that is found; all documents stay."""
    return _back(secret_scan.redact(_apart(docs), secret_scan.fit(docs)), docs)


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and proof of the round trip."""
    return bpe.round_trip(docs, VOCABULARY, PATTERN, keep=["doc_id"], with_ids=True)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmarks),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_bpe),
]
#: The stages fit models and run Python over texts; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written_at(stage(spark, docs, sf_dir), name)
        if before:
            remove(spark, before)  # the stage that read it is written
        before = path
    return docs
