"""Grading: extracted texts against reference texts, per tag.

Inputs have (tag, idx, text), idx in reading order.  Sets, sizes and scores are
DataFrame work; only the order-dependent pairing runs per tag in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.functions.text import grams, keep_only, scrub
from linefold.operators import matching, ordered
from linefold.operators.similarity import overlaps

OK, LEAST_CHARS, SCOPE_GAP, DUPLICATE = 0.85, 6, 15, 0.6
HEAD = 110

# Markup that is no text, in the order it goes, and endings that count as one.
MARKUP = [(r"!\[[^\]]*\]\([^)]*\)", " "), (r"\\includegraphics(?:\[[^\]]*\])?\{[^}]*\}", " ")]
FORMULAS = [(r"(?s)\$\$.*?\$\$|\\\[.*?\\\]", " "), (r"(?s)\$[^$]*\$|\\\(.*?\\\)", " ")]
COMMANDS = [(r"\\[A-Za-z]+\*?", " "), (r"\$", " ")]
ENDINGS = [("하시오", "하라"), ("하여라", "하라"), ("푸시오", "풀라")]


def skeleton(text: Column, keep_math: bool = False) -> Column:
    t = scrub(text, MARKUP + ([] if keep_math else FORMULAS) + COMMANDS)
    if keep_math:
        return F.regexp_replace(t, "[^가-힣0-9A-Za-z]+", "")
    return scrub(keep_only(t, "[가-힣]+"), ENDINGS)


def _prepared(df: DataFrame, keep_math: bool) -> DataFrame:
    s = skeleton(F.coalesce("text", F.lit("")), keep_math)
    return df.select("tag", "idx", "text", s.alias("bare")).withColumn("grams", grams("bare")).withColumn("size", F.size("grams").cast("long"))


def pair_up(refs: DataFrame, exts: DataFrame, keep_math: bool = False) -> DataFrame:
    """tag, ref_idx, ext_idx, sim, how, recall, precision, verdict."""
    r, e = _prepared(refs, keep_math), _prepared(exts, keep_math)
    pairs = matching.aligned(r, e, "tag")
    pairs = pairs.join(r.select("tag", F.col("idx").alias("ref_idx"), F.col("bare").alias("ref_bare")), ["tag", "ref_idx"])
    pairs = pairs.join(e.select("tag", F.col("idx").alias("ext_idx"), F.col("bare").alias("ext_bare")), ["tag", "ext_idx"])
    pairs = matching.overlap(pairs, "ref_bare", "ext_bare")
    short = (F.length("ref_bare") < LEAST_CHARS) & (F.length("ext_bare") < LEAST_CHARS)
    rec, pre = F.col("recall") >= OK, F.col("precision") >= OK
    verdict = F.when(short, "판정보류").when(rec & pre, "완전일치").when(pre, "잘림").when(rec, "넘침").otherwise("부분일치")
    return pairs.select("tag", "ref_idx", "ext_idx", "sim", "how", "recall", "precision", verdict.alias("verdict"))


def in_scope(pairs: DataFrame, gap: int = SCOPE_GAP) -> DataFrame:
    """(tag, ref_idx) of matched references and of gaps of at most ``gap`` between them."""
    m = pairs.select("tag", "ref_idx").distinct().withColumn("nx", F.lead("ref_idx").over(Window.partitionBy("tag").orderBy("ref_idx")))
    upto = F.when((F.col("nx") - F.col("ref_idx") - 1).between(1, gap), F.col("nx") - 1).otherwise(F.col("ref_idx"))
    return m.select("tag", F.explode(F.sequence("ref_idx", upto)).alias("ref_idx"))


def out_of_scope(refs: DataFrame, scope: DataFrame) -> DataFrame:
    """Islands of references out of scope: tag, first, last, n."""
    left = refs.select("tag", F.col("idx").alias("ref_idx")).join(scope, ["tag", "ref_idx"], "left_anti")
    return ordered.islands(left, ["tag"], "ref_idx")


def missed(refs: DataFrame, pairs: DataFrame, scope: DataFrame) -> DataFrame:
    """References in scope without a pair."""
    r = refs.select("tag", F.col("idx").alias("ref_idx"))
    return r.join(scope, ["tag", "ref_idx"], "left_semi").join(pairs.select("tag", "ref_idx"), ["tag", "ref_idx"], "left_anti")


def unpaired(refs: DataFrame, exts: DataFrame, pairs: DataFrame, keep_math: bool = False) -> DataFrame:
    """Extracted texts without a pair: tag, ext_idx, state (false, duplicate, short).

    A text that resembles any reference, with its full text or its head, is a duplicate.
    """
    left = exts.join(pairs.select("tag", F.col("ext_idx").alias("idx")), ["tag", "idx"], "left_anti")
    full = _prepared(left, keep_math)
    head = _prepared(left.withColumn("text", F.substring("text", 1, HEAD)), False)
    r = _prepared(refs, keep_math).withColumnRenamed("idx", "ref_idx")
    like = None
    for side in (full, head):
        alike = lambda inter, a, b: (inter / (a + b - inter) >= DUPLICATE) | ((inter >= 10) & ((inter / a >= DUPLICATE) | (inter / b >= DUPLICATE)))
        near = overlaps(side, r, ["tag", "idx"], ["tag", "ref_idx"], on=["tag"], keep=alike).select("tag", "idx")
        like = near if like is None else like.unionByName(near)
    out = full.join(like.distinct().withColumn("alike", F.lit(True)), ["tag", "idx"], "left")
    state = F.when(F.col("alike"), "duplicate").when(F.length("bare") < LEAST_CHARS, "short").otherwise("false")
    return out.select("tag", F.col("idx").alias("ext_idx"), state.alias("state"))


def score(refs: DataFrame, exts: DataFrame, keep_math: bool = False) -> DataFrame:
    """One row per tag: verdict counts, scope, accuracy, miss rate and false rate (half-even, 4 digits; 0 without a denominator)."""
    pairs = pair_up(refs, exts, keep_math).persist()
    scope = in_scope(pairs)
    is_ = lambda v: F.count_if(F.col("verdict") == v)
    v = pairs.groupBy("tag").agg(is_("완전일치").alias("exact"), is_("잘림").alias("truncated"), is_("넘침").alias("overflow"), is_("부분일치").alias("partial"), is_("판정보류").alias("undecided"))
    counts = [
        refs.groupBy("tag").agg(F.count("*").alias("refs")),
        exts.groupBy("tag").agg(F.count("*").alias("exts")),
        scope.join(refs.select("tag", F.col("idx").alias("ref_idx")), ["tag", "ref_idx"], "left_semi").groupBy("tag").agg(F.count("*").alias("in_scope")),
        missed(refs, pairs, scope).groupBy("tag").agg(F.count("*").alias("missed")),
        unpaired(refs, exts, pairs, keep_math).groupBy("tag").agg(F.count_if(F.col("state") == "false").alias("false"), F.count_if(F.col("state") == "duplicate").alias("duplicates")),
        v,
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.join(c, "tag", "full")
    out = out.na.fill(0)
    rate = lambda a, b: F.when(F.col(b) > 0, F.bround(F.col(a) / F.col(b), 4)).otherwise(0.0)
    return out.withColumns({"accuracy": rate("exact", "in_scope"), "miss_rate": rate("missed", "in_scope"), "false_rate": rate("false", "exts")})


def deltas(history: DataFrame) -> DataFrame:
    """Difference of each run's measures to the run before it of the same tag; ord is the run's place."""
    w = Window.partitionBy("tag").orderBy("ord")
    better = {"accuracy": 1, "miss_rate": -1, "false_rate": -1}
    cols = [(F.col(c) - F.lag(c).over(w)).alias(f"{c}_delta") for c in better]
    good = [((F.col(c) - F.lag(c).over(w)) * s > 0).alias(f"{c}_better") for c, s in better.items()]
    return history.select("tag", "ord", *cols, *good)
