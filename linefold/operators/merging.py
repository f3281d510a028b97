"""Lines that a page layout cut, put together again.

A line continues the text before it if it says so (``glue`` is the separator),
if it is a blank box, or if it stands beside the box right before it.  Figures
are units of their own and do not break the text around them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.operators import ordered

BOX = "□"
#: How far a box reaches above and below itself.
BESIDE = 10


def units(lines: DataFrame, group: str, particle: Column) -> DataFrame:
    """(group, first, kind, text, n): lines has (group, idx, kind 'text' | 'figure' | 'box', text, glue, page, y, height).

    A line for which ``particle`` holds is joined without a blank.
    """
    w = ordered.order([group], ["idx"])
    box = F.col("kind") == "box"
    lag = lambda c: F.lag(c).over(w)
    row = lines.withColumn("_y", F.when(box, F.col("y"))).withColumn("_h", F.when(box, F.coalesce("height", F.lit(0.0))))
    row = row.withColumn("_before", F.struct(lag("page").alias("page"), lag("_y").alias("y"), lag("_h").alias("h")))
    beside = (F.col("page") == F.col("_before.page")) & (F.col("y") < F.col("_before.y") + F.col("_before.h") + BESIDE) & (F.col("y") + F.coalesce("height", F.lit(0.0)) > F.col("_before.y") - BESIDE)
    beside = F.coalesce(beside & F.col("glue").isNull() & (F.col("text") != ""), F.lit(False))
    sep = F.when(box, " ").when(F.col("glue").isNotNull(), F.when(particle, "").otherwise(F.col("glue"))).when(beside, F.when(particle, "").otherwise(" "))
    figure = F.col("kind") == "figure"
    row = row.withColumn("_sep", F.when(~figure, sep)).withColumn("_text", F.when(box, BOX).otherwise(F.coalesce("text", F.lit(""))))
    start = (~figure & F.col("_sep").isNull()).cast("int")
    # the first text of a group is a unit even if it is marked as a continuation
    texts = row.where(~figure).withColumn("_unit", F.sum(start).over(w.rowsBetween(-(2**63), 0)))
    piece = F.struct("idx", F.when(F.col("_text") != "", F.concat(F.coalesce("_sep", F.lit("")), "_text")).otherwise("").alias("piece"), "_text")
    held = texts.groupBy(group, "_unit").agg(F.min("idx").alias("first"), F.count("*").alias("n"), F.sort_array(F.collect_list(piece)).alias("all"))
    full = F.filter("all", lambda x: x["_text"] != "")
    joined = F.concat(F.coalesce(F.try_element_at(full, F.lit(1))["_text"], F.lit("")), F.array_join(F.transform(F.slice(full, 2, F.greatest(F.size(full), F.lit(1))), lambda x: x["piece"]), ""))
    made = held.select(group, "first", F.lit("text").alias("kind"), joined.alias("text"), "n")
    return made.union(row.where(figure).select(group, F.col("idx").alias("first"), F.lit("figure").alias("kind"), "text", F.lit(1).cast("long").alias("n")))
