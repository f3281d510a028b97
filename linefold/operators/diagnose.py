"""Why references were missed, where unowned figures lie, and the state of each file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.operators import ordered
from linefold.operators.grade import skeleton
from linefold.operators.patterns import FIGURE_TYPES
from linefold.operators.similarity import best_match, gram_sets, overlaps

LEAST_SIM, NEAR, LOW_CONFIDENCE = 0.18, 3, 0.6


def why_missed(missed: DataFrame, live: DataFrame, bridge: DataFrame, kept: DataFrame) -> DataFrame:
    """(ref_id, why, sim, line_id): missed has (ref_id, head), live the marked lines with line_id, kept (file, idx) the starts."""
    g = lambda df, key, text: gram_sets(df.select(key, skeleton(F.col(text)).alias("s")).where("s != ''"), [key], "s")
    pairs = overlaps(g(missed, "ref_id", "head"), g(live, "line_id", "t"), ["ref_id"], ["line_id"], keep=lambda inter, a, b: inter / (a + b - inter) >= LEAST_SIM)
    best = best_match(pairs, ["ref_id"], "jaccard", "line_id", LEAST_SIM)
    w = ordered.order(["file"], ["idx"]).rowsBetween(-NEAR, NEAR)
    near = F.first(F.when(F.col("m").isNotNull(), F.struct("idx", "m.name")), ignorenulls=True).over(w)
    context = live.select("line_id", "file", "idx", near.alias("near"))
    starts = kept.select("file", F.col("idx").alias("near_idx"), F.lit(True).alias("is_start"))
    owner = bridge.select("file", "idx", F.lit(True).alias("inside")).distinct()
    r = missed.select("ref_id").join(best, "ref_id", "left").join(context, "line_id", "left").withColumn("near_idx", F.col("near.idx"))
    r = r.join(starts, ["file", "near_idx"], "left").join(owner, ["file", "idx"], "left")
    why = (
        F.when(F.col("jaccard").isNull(), "원본에없음")
        .when(F.col("near").isNotNull() & F.col("is_start").isNull(), "표기있음")
        .when(F.col("inside"), "흡수됨")
        .when(F.col("near").isNotNull(), "표기있음")
        .otherwise("표기없음")
    )
    return r.select("ref_id", why.alias("why"), F.bround("jaccard", 2).alias("sim"), "line_id")


def orphan_kinds(orphans: DataFrame, problems: DataFrame, bridge: DataFrame) -> DataFrame:
    """Unowned figures (file, page, fig) by where they lie: a page without problems, before, after or between problems."""
    spans = bridge.groupBy("file", "start").agg(F.min("idx").alias("first"), F.max("idx").alias("last"))
    with_problem = problems.select("file", "page").distinct().withColumn("has", F.lit(True))
    o = ordered.asof(orphans, spans.select("file", F.col("last").alias("at"), "start"), ["file"], "fig", "at", "start", strict=True, out="before")
    back = o.withColumn("rev", -F.col("fig"))
    o = ordered.asof(back, spans.select("file", (-F.col("first")).alias("at"), "start"), ["file"], "rev", "at", "start", strict=True, out="after").drop("rev")
    kind = F.when(F.col("has").isNull(), "문제없는쪽").when(F.col("before").isNull(), "문제앞").when(F.col("after").isNull(), "문제뒤").otherwise("문제사이")
    return o.join(with_problem, ["file", "page"], "left").select("file", "page", "fig", "before", "after", kind.alias("kind"))


def file_state(live: DataFrame, problems: DataFrame) -> DataFrame:
    """Per file: pages, problems, empty or one-line problems, lines of low confidence, figures."""
    fig = F.col("type").isin(*FIGURE_TYPES)
    lines = live.groupBy("file").agg(
        F.countDistinct("page").alias("pages"), F.count_if((F.col("confidence") < LOW_CONFIDENCE) & (F.col("t") != "")).alias("low_confidence"), F.count_if(fig).alias("figures")
    )
    p = problems.groupBy("file").agg(F.count("*").alias("problems"), F.count_if((F.col("lines") <= 1) & (F.size("figs") == 0)).alias("thin"))
    return lines.join(p, "file", "left").na.fill(0)
