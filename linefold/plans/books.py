"""Queries that run the extractor and the grader whole, over books made of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from linefold.operators import extract as E
from linefold.operators import grade
from linefold.plans.registry import query
from linefold.sources.tables import lines, table


def book_lines(spark, d):
    """Each document as a file of page lines: ten lines a page, every third line a numbered task, tables as figures."""
    n = F.col("idx")
    task = (n % 3 == 1) & ~F.contains("text", F.lit("|"))
    kind = F.when(F.contains("text", F.lit("|")), "diagram").when(n % 17 == 0, "section_header").otherwise("text")
    text = F.when(task, F.concat(F.lit("문제 "), F.floor(n / 3 + 1).cast("string"), F.lit(" "), F.col("text"), F.lit(" 구하시오."))).otherwise(F.col("text"))
    y = (n % 10) * 60.0
    region = F.struct(F.when(n % 2 == 0, 120.0).otherwise(140.0).alias("top_left_x"), y.alias("top_left_y"), F.lit(300.0).alias("width"), F.lit(20.0).alias("height"))
    return lines(spark, d).select(
        F.col("doc_id").cast("string").alias("file"),
        (F.floor(n / 10) + 1).cast("int").alias("page"),
        F.lit(1000.0).alias("page_width"),
        F.lit(1400.0).alias("page_height"),
        n.alias("ord"),
        F.concat_ws("-", "doc_id", "idx").alias("id"),
        F.lit(None).cast("string").alias("parent_id"),
        kind.alias("type"),
        F.lit(None).cast("string").alias("subtype"),
        text.alias("text"),
        F.lit(None).cast("string").alias("text_display"),
        region.alias("region"),
        F.lit(20.0).alias("font_size"),
        F.lit(0).alias("column"),
        n.cast("int").alias("line"),
        F.lit(None).cast("boolean").alias("conversion_output"),
        F.lit(0.9).alias("confidence"),
    )


@query("ext1_problems")
def ext1(spark, d):
    """All stages of the extractor: problems with their numbers, extent, end reason and figures."""
    problems, _, _ = E.extract(book_lines(spark, d))
    return problems.select(F.col("file").cast("long").alias("doc_id"), "start", "name", "num", "page", "lines", "reason", F.size("figs").alias("n_figs"), F.size("figs_guess").alias("n_near"))


@query("grd1_scores")
def grd1(spark, d):
    """Assistant turns graded against user turns of the same conversation: verdicts, scope and rates."""
    c = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("tag"), F.col("turn").alias("idx"), "text", "role")
    side = lambda role: c.where(F.col("role") == role).drop("role")
    return grade.score(side("user"), side("assistant"), keep_math=True)
