"""The extractor: ordered page lines to numbered problems with their lines and figures.

``extract(rows)`` takes lines of the canonical schema (see ``LINES``) and
returns problems, the bridge to their lines, and figure counts.  Every window
is within a file; what one file's lines say never reaches another file's
(except exact dedup, which has a switch).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.functions.text import first_text, match_marker
from linefold.operators import matching, ordered
from linefold.session import written
from linefold.operators.patterns import (
    ACTIVITY_INTRO,
    BODY_TYPES,
    CHOICE_HEAD,
    CHOICE_ITEM,
    CONCEPT_HEAD,
    CONTAINER_TYPES,
    CONTINUE_SUBTYPES,
    DELATEX,
    DROP_TYPES,
    FALSE_FOLLOW,
    FALSE_FOLLOW_KEEP,
    FIGURE_REF,
    FIGURE_TYPES,
    INTRO_CORNER,
    ORDER_END,
    ORDER_END_ANY,
    PREP_HEAD,
    PROVISO,
    REVIEW_CORNER,
    SOLUTION,
    SOLUTION_BIT,
    START_PATTERNS,
    STRONG_END,
    SUB_ITEM,
    WEAK_START,
)

LINES = """file string, page int, page_width double, page_height double, ord long, id string, parent_id string, type string, subtype string,
text string, text_display string, region struct<top_left_x: double, top_left_y: double, width: double, height: double>, font_size double,
column int, line int, conversion_output boolean, confidence double"""

GAP_LOW, GAP_HIGH, GAP_FACTOR, GAP_LEAST = -20, 400, 4, 60
BAND_WIDTH, BAND_TOLERANCE = 50, 90
MAX_LINES, MAX_PAGES = 60, 1
TITLE_FONT, WIDE_SHARE = 60, 0.75
FIG_MENTIONED, FIG_NEAR, FIG_SHARED = 400, 120, 60
ORDER = ["page_", "line_", "y_", "ord"]


def exit_reasons(rows: DataFrame, group: list[str], solution_kinds: list[str], max_lines: int = MAX_LINES, max_pages: int = MAX_PAGES) -> DataFrame:
    """Append ``reason``, why a segment would end before this line, if it would.

    ``rows``: group, idx, start (the head's idx), page, and the flags is_head_line
    (a section header), far, passive (figure, formula or empty), joined (a tight
    continuation), order_end, rider (belongs to the text even after its end), sub,
    solution; kind of the head.
    """
    w = Window.partitionBy(*group, "start").orderBy("idx")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    r = rows.withColumn("at", F.row_number().over(w) - 1)
    r = r.withColumn("last_page", F.last("page", ignorenulls=True).over(before))
    turned = F.coalesce((F.col("at") > 0) & (F.col("page") != F.col("last_page")), F.lit(False)).cast("int")
    r = r.withColumn("turned", turned).withColumn("pages", F.sum("turned").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    may_end = (F.col("at") == 0) | (~F.col("passive") & ((F.col("joined") & ~F.col("far")) | ~F.col("sub")))
    r = r.withColumn("seen", F.coalesce(F.max((may_end & F.col("order_end")).cast("int")).over(before), F.lit(0)) == 1)
    plain = ~F.col("passive") & ~(F.col("joined") & ~F.col("far")) & ~(F.col("seen") & F.col("rider")) & ~F.col("sub")
    reason = (
        F.when(F.col("at") == 0, None)
        .when((F.col("turned") == 1) & (F.col("pages") > max_pages), "페이지초과")
        .when(F.col("is_head_line"), "단원제목")
        .when(F.col("seen") & F.col("far"), "간격")
        .when(F.col("at") >= max_lines, "길이초과")
        .when(plain & F.col("kind").isin(solution_kinds) & F.col("solution"), "풀이시작")
        .when(plain & F.col("seen"), "본문종료")
    )
    return r.withColumn("reason", reason)


def _cut(found: DataFrame, group: list[str], *more: Column) -> DataFrame:
    """group, start, end (exclusive), reason of each segment, and ``more`` aggregates of its lines."""
    cut = F.min(F.when(F.col("reason").isNotNull(), F.struct("idx", "reason"))).alias("cut")
    out = found.groupBy(*group, "start").agg(cut, F.max("idx").alias("last"), *more)
    return out.withColumns({"end": F.coalesce(F.col("cut.idx"), F.col("last") + 1), "reason": F.coalesce("cut.reason", F.lit("다음문제"))}).drop("cut", "last")


def segment_exits(rows: DataFrame, group: list[str], solution_kinds: list[str], max_lines: int = MAX_LINES, max_pages: int = MAX_PAGES) -> DataFrame:
    """Cut each segment of ``rows`` (see ``exit_reasons``) at its first line with an exit reason: group, start, end (exclusive), reason."""
    return _cut(exit_reasons(rows, group, solution_kinds, max_lines, max_pages), group).select(*group, "start", "end", "reason")


def _is_image(t: Column) -> Column:
    return t.startswith("![](") | F.contains(t, F.lit("\\includegraphics"))


def marker_of(t: Column, font: Column) -> Column:
    """The first start pattern on the text, then on its readings without a formula frame around the number."""
    found = [match_marker(t, START_PATTERNS)]
    for pattern, by in DELATEX:
        found.append(F.when(t.rlike(pattern), match_marker(F.regexp_replace(t, pattern, by), START_PATTERNS)))
    return F.when((t == "") | _is_image(t) | F.coalesce(font > TITLE_FONT, F.lit(False)), None).otherwise(F.coalesce(*found))


def distinct_lines(rows: DataFrame, per_file: bool = False) -> DataFrame:
    """Exact copies (type, text, place, page) go, the first in arrival order stays; without text all stay.  Dealt by file.

    Lines meet the copies in other files as digests alone; where an earlier file
    has one, a mark goes to the file, so that whole lines are shuffled once, by file.
    """
    place = {"_y": F.col("region.top_left_y"), "_x": F.col("region.top_left_x"), "_text": F.unhex(F.sha2("text", 256)), "_mark": F.lit(False)}
    key = ["type", "_text", "_y", "_x", "page"]
    r = rows.withColumns(place | {"_has": F.coalesce(F.col("text") != "", F.lit(False))})
    both = r
    if not per_file:
        again = r.where("_has").select("file", *key).withColumn("_rank", F.rank().over(Window.partitionBy(*key).orderBy("file"))).where("_rank > 1")
        both = r.unionByName(again.select("file", *key, F.lit(True).alias("_mark"), F.lit(True).alias("_has")), allowMissingColumns=True)
    w = Window.partitionBy("file", "_has", *key).orderBy(F.desc("_mark"), "ord")
    first = both.repartition("file").withColumn("_rn", F.row_number().over(w))
    return first.where(~F.col("_has") | ((F.col("_rn") == 1) & ~F.col("_mark"))).drop("_rn", "_has", *place)


def with_text(rows: DataFrame) -> DataFrame:
    """Append t, the line's text."""
    return rows.withColumn("t", first_text("text", "text_display"))


def flagged_lines(rows: DataFrame) -> DataFrame:
    """Lines with t, which are ``gone`` or count; these are numbered in reading order within the file, with their flags."""
    wide = F.col("type").isin(*FIGURE_TYPES) & F.coalesce(F.col("region.width") > F.coalesce(F.nullif("page_width", F.lit(0.0)), "doc_width") * WIDE_SHARE, F.lit(False))
    drop = F.coalesce(F.col("type").isin(*DROP_TYPES), F.lit(False)) | F.col("conversion_output").eqNullSafe(False) | F.coalesce(wide, F.lit(False))
    r = rows.withColumn("doc_width", F.max("page_width").over(Window.partitionBy("file")))
    review = F.max(F.col("t").rlike(REVIEW_CORNER)).over(Window.partitionBy("file", "page"))
    r = r.withColumn("is_review", F.coalesce(review & F.col("page").isNotNull(), F.lit(False))).withColumn("gone", drop)
    r = r.withColumns({"page_": F.coalesce("page", F.lit(0)), "line_": F.coalesce("line", F.lit(1_000_000)), "y_": F.coalesce("region.top_left_y", F.lit(0.0))})
    f, by = ["file", "gone"], ["idx"]
    r = ordered.numbered(r, f, ORDER)
    corner = F.when((F.col("type") == "section_header") | F.col("t").rlike(INTRO_CORNER), F.col("t").rlike(INTRO_CORNER))
    r = r.withColumn("in_corner", F.coalesce(ordered.carried(corner, f, by), F.lit(False)))
    previous = lambda c: F.lag(c).over(ordered.order(f, by))
    gap = F.when(previous(F.col("page")).eqNullSafe(F.col("page")), F.col("region.top_left_y") - previous(F.col("region.top_left_y") + F.coalesce("region.height", F.lit(0.0))))
    return r.withColumn("gap", gap)


def live_lines(rows: DataFrame) -> DataFrame:
    """Of lines with t those that count, numbered in reading order within the file, with their flags."""
    return flagged_lines(rows).where(~F.col("gone")).drop("gone")


def starts(lines: DataFrame) -> DataFrame:
    """Append m (see ``marker_of``) and ``may_start``: whether a line may start a problem, its parent aside."""
    f, by, t = ["file", "gone"], ["idx"], F.col("t")
    c = lines.withColumn("m", F.when(~F.col("gone"), marker_of(t, F.col("font_size"))))
    c = c.withColumn("_ahead", ordered.ahead_text(t, 8, f, by))
    c = c.withColumn("_after_intro", ordered.any_near(t.rlike(ACTIVITY_INTRO), 3, -1, f, by))
    c = c.withColumn("_head", ordered.carried(F.when((F.col("type") == "section_header") & (t != ""), t), f, by, back=40, current=False))
    weak_ok = (
        ~F.coalesce(F.col("subtype").isin(*CONTINUE_SUBTYPES), F.lit(False))
        & ~F.col("_after_intro")
        & ~F.col("is_review")
        & ~F.col("in_corner")
        & (~t.rlike(FALSE_FOLLOW) | t.rlike(FALSE_FOLLOW_KEEP))
        & ~t.rlike(CONCEPT_HEAD)
        & ~t.rlike(SOLUTION_BIT)
        & (F.col("_ahead").rlike(ORDER_END) | F.col("_ahead").rlike(ORDER_END_ANY))
        & ~F.coalesce(F.col("_head").rlike(PREP_HEAD), F.lit(False))
    )
    ok = F.col("m").isNotNull() & F.col("type").isin(*BODY_TYPES) & (~F.col("m.name").isin(*WEAK_START) | weak_ok)
    return c.withColumn("may_start", F.coalesce(ok, F.lit(False))).drop("_ahead", "_after_intro", "_head")


def candidates(rows: DataFrame) -> DataFrame:
    """Of lines with ``may_start`` (see ``starts``) those that may start a problem under their parent."""
    c = rows.where(F.col("may_start") & ~F.col("gone"))
    child = F.nullif("parent_id", F.lit("")).isNotNull()
    wanted = c.where(child).select("file", F.col("parent_id").alias("id")).distinct()
    named = rows.select("file", "id", "ord", "type", (F.col("t") != "").alias("has_text")).join(wanted, ["file", "id"], "left_semi")
    parents = named.groupBy("file", F.col("id").alias("parent_id")).agg(F.max(F.struct("ord", "type", "has_text")).alias("p"))
    fields = ["file", "idx", "page", F.col("region.top_left_x").alias("x"), F.col("font_size").alias("font"), F.col("m.name").alias("name"), F.col("m.raw").alias("raw"), F.col("m.kind").alias("kind")]
    shell = F.col("p").isNull() | F.coalesce(F.col("p.type").isin(*CONTAINER_TYPES), F.lit(False)) | ~F.col("p.has_text")
    under = c.where(child).select(*fields, "parent_id").join(parents, ["file", "parent_id"], "left").where(shell).drop("parent_id", "p")
    return c.where(~child).select(*fields).unionByName(under)


def in_bands(cands: DataFrame) -> DataFrame:
    """Candidates within reach of a learnt x band of their file; without x they stay."""
    bucket = F.floor(F.col("x") / BAND_WIDTH)
    n = cands.where("x is not null").groupBy("file", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    n = n.withColumn("most", F.max("n").over(Window.partitionBy("file"))).where("n >= 2 or n = most")
    bands = n.groupBy("file").agg(F.collect_list((F.col("bucket") + 0.5) * BAND_WIDTH).alias("centres"))
    near = F.exists("centres", lambda c: F.abs(F.col("x") - c) <= BAND_TOLERANCE)
    return cands.join(bands, "file", "left").where(F.col("centres").isNull() | F.col("x").isNull() | near).drop("centres")


def unmarked(live: DataFrame, kept: DataFrame, threshold: DataFrame) -> DataFrame:
    """Optional candidates without a marker: paragraphs in a band, set off by a gap, in the usual type size, that end as a task.

    Each is more than two lines from every marked one and from the one taken before it.
    """
    fonts = kept.where("font is not null").groupBy("file").agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY font DESC)").alias("usual"))
    bands = kept.where("x is not null").groupBy("file", F.floor(F.col("x") / BAND_WIDTH).alias("bucket")).agg(F.count("*").alias("n"))
    bands = bands.withColumn("most", F.max("n").over(Window.partitionBy("file"))).where("n >= 2 or n = most")
    bands = bands.groupBy("file").agg(F.collect_list((F.col("bucket") + 0.5) * BAND_WIDTH).alias("centres"))
    t = F.col("t")
    c = live.join(kept.select("file", "idx", F.lit(True).alias("taken")), ["file", "idx"], "left")
    c = c.withColumn("near", ordered.any_near(F.col("taken"), 2, 2, ["file"], ["idx"]))
    ahead = ordered.ahead_text(t, 8, ["file"], ["idx"])
    c = c.withColumn("has_end", ahead.rlike(ORDER_END) | ahead.rlike(ORDER_END_ANY))
    c = c.join(fonts, "file", "left").join(bands, "file").join(threshold, "file")
    plain = F.col("type").isin(*BODY_TYPES) & (F.length(t) >= 12) & ~_is_image(t) & ~t.rlike(SUB_ITEM) & ~t.rlike(SOLUTION) & F.col("m").isNull() & t.rlike("^[가-힣]")
    placed = F.exists("centres", lambda x: F.abs(F.col("region.top_left_x") - x) <= BAND_TOLERANCE) & (F.col("gap") >= F.col("threshold"))
    sized = F.col("usual").isNull() | F.col("font_size").isNull() | (F.abs(F.col("font_size") - F.col("usual")) <= 6)
    c = c.where(~F.col("near") & ~F.col("in_corner") & plain & placed & sized & F.col("has_end"))
    picks = matching.spaced(c.select("file", "idx"), "file", "true", 2)
    fields = c.select("file", "idx", "page", F.col("region.top_left_x").alias("x"), F.col("font_size").alias("font"), F.lit("지문").alias("name"), F.lit(None).cast("string").alias("raw"), F.lit("문제").alias("kind"))
    return fields.join(picks, ["file", "idx"])


def extract(rows: DataFrame, per_file_dedup: bool = False, with_unmarked: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(problems, lines of problems, figures of problems).

    Whole lines are shuffled by file twice and written once: for their flags, and
    when problems take theirs; what lies between reads columns without texts.
    Tables that several steps use are written to the shared folder, which also
    keeps plans small and lets later steps outlive lost executors.
    """
    used = ["file", "page", "idx", "gone", "ord", "id", "parent_id", "type", "subtype", "t", "region", "y_", "font_size", "in_corner", "gap", "m", "may_start"]
    rows = written(starts(flagged_lines(distinct_lines(with_text(rows), per_file_dedup))).select(*used), "rows")
    live = rows.where(~F.col("gone"))
    kept = written(in_bands(candidates(rows)), "kept")
    threshold = ordered.learned_gap(live, ["file"], "gap", GAP_LOW, GAP_HIGH, GAP_FACTOR, GAP_LEAST)
    if with_unmarked:
        kept = written(kept.unionByName(unmarked(live, kept, threshold)), "kept")
    kept = written(kept.join(matching.repaired(kept, "file", heir="문제"), ["file", "idx"]).join(threshold, "file", "left"), "kept")
    # each head stands before its line, and every line carries the last one
    fields = [c for c in kept.columns if c not in ("file", "idx", "threshold")]
    heads = kept.select("file", "idx", F.struct(F.col("idx").alias("start"), "threshold", *fields).alias("_head"))
    t = F.col("t")
    seg = live.select("file", "idx", "page", "type", "subtype", "t", "gap", F.col("region.top_left_y").alias("y"), F.lit(True).alias("_line"))
    seg = seg.unionByName(heads, allowMissingColumns=True).repartition("file")
    seg = seg.withColumn("_head", ordered.carried(F.col("_head"), ["file"], ["idx", F.col("_line").asc_nulls_first()])).where("_line and _head is not null")
    flags = {
        "start": F.col("_head.start"),
        "kind": F.col("_head.kind"),
        "is_head_line": F.coalesce(F.col("type") == "section_header", F.lit(False)),
        "far": F.coalesce(F.col("gap") > F.col("_head.threshold"), F.lit(False)),
        "passive": F.coalesce(F.col("type").isin(*FIGURE_TYPES, "math"), F.lit(False)) | t.startswith("\\[") | t.startswith("$$") | (t == ""),
        "joined": F.coalesce(F.col("subtype").isin(*CONTINUE_SUBTYPES), F.lit(False)),
        "order_end": t.rlike(ORDER_END),
        "rider": t.rlike(PROVISO) | t.rlike(CHOICE_HEAD) | t.rlike(CHOICE_ITEM),
        "sub": t.rlike(SUB_ITEM),
        "solution": t.rlike(SOLUTION),
    }
    found = exit_reasons(seg.withColumns(flags), ["file"], ["예제", "유제"])
    is_fig = F.col("type").isin(*FIGURE_TYPES)
    ended = F.max(F.col("reason").isNotNull()).over(Window.partitionBy("file", "start").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0))
    own = F.when(~F.col("_ended"), F.struct("idx", "page", "t", "type", "y", F.coalesce(is_fig, F.lit(False)).alias("is_fig")))
    p = _cut(found.withColumn("_ended", ended), ["file"], F.first("_head").alias("_head"), F.sort_array(F.collect_list(own)).alias("rows"))
    p = p.select("file", "start", *[F.col("_head")[c].alias(c) for c in fields], "end", "reason", "rows")
    p = p.withColumns(
        {
            "texts": F.transform("rows", lambda x: x["t"]),
            "lines": F.size("rows").cast("long"),
            "y0": F.array_min(F.transform("rows", lambda x: x["y"])),
            "y1": F.array_max(F.transform("rows", lambda x: x["y"])),
            "figs": F.transform(F.filter("rows", lambda x: x["is_fig"]), lambda x: x["idx"]),
        }
    )
    last_file = live.agg(F.max("file")).scalar()
    ended = F.when((F.col("reason") == "다음문제") & (F.col("file") != last_file) & (F.lead("start").over(ordered.order(["file"], ["start"])).isNull()), "파일경계").otherwise(F.col("reason"))
    p = p.withColumn("reason", ended)
    body_text = F.regexp_replace(F.array_join("texts", ""), r"!\[[^\]]*\]\([^)]{0,300}\)|https?://\S+", "")
    first = F.coalesce(F.element_at(F.filter("texts", lambda x: x != ""), 1), F.lit(""))
    weakish = F.col("name").isin(*WEAK_START, "두자리")
    p = p.where(~weakish | (~first.rlike(r"(?U)^\s*풀이\s*[(（]") & body_text.rlike(STRONG_END)))
    p = p.withColumn("mentions", F.array_join("texts", " ").rlike(FIGURE_REF)).withColumn("head", F.substring(F.element_at("texts", 1), 1, 90))
    p = written(p.drop("texts"), "problems")

    figs = live.where(is_fig & F.col("y_").isNotNull() & F.col("region.top_left_y").isNotNull()).select(
        "file", "page", F.col("idx").alias("fig"), F.col("region.top_left_y").alias("fy"), F.coalesce("region.height", F.lit(0.0)).alias("fh")
    )
    owned = p.select("file", "start", F.explode("figs").alias("fig"))
    uses = owned.groupBy("file", "fig").agg(F.count("*").alias("owners"))
    distance = F.greatest(F.col("y0") - (F.col("fy") + F.col("fh")), F.col("fy") - F.col("y1"), F.lit(0.0))
    near = p.where("y0 is not null").select("file", "page", "start", "y0", "y1", "mentions", F.size("figs").alias("n_figs")).join(figs, ["file", "page"])
    near = near.withColumn("distance", distance).join(uses, ["file", "fig"], "left").withColumn("owners", F.coalesce("owners", F.lit(0)))
    near = written(near, "near")
    by_fig = Window.partitionBy("file", "fig").orderBy("start")
    reach = F.when(F.col("mentions"), FIG_MENTIONED).otherwise(FIG_NEAR)
    one = near.where((F.col("owners") == 0) & (F.col("distance") <= reach)).withColumn("k", F.row_number().over(by_fig)).where("k = 1").select("file", "start", "fig")
    got = one.select("file", "start").distinct()
    used = one.groupBy("file", "fig").agg(F.count("*").alias("now"))
    rest = near.where((F.col("n_figs") == 0) & (F.col("distance") <= FIG_SHARED)).join(got, ["file", "start"], "left_anti").join(used, ["file", "fig"], "left")
    rest = rest.withColumn("k", F.row_number().over(by_fig)).where(F.col("k") <= 2 - F.col("owners") - F.coalesce("now", F.lit(0))).select("file", "start", "fig")
    guesses = one.unionByName(rest)
    guessed = guesses.groupBy("file", "start").agg(F.sort_array(F.collect_list("fig")).alias("figs_guess"))
    problems = p.join(guessed, ["file", "start"], "left").withColumn("figs_guess", F.coalesce("figs_guess", F.array().cast("array<bigint>")))
    problems = problems.withColumn("text", F.array_join(F.transform("rows", lambda x: x["t"]), "\n"))
    bridge = p.select("file", "start", F.inline("rows"))
    shown = owned.withColumn("how", F.lit("body")).unionByName(guesses.withColumn("how", F.lit("near")))
    return problems.drop("y0", "y1", "rows"), bridge, shown


def orphan_figures(rows: DataFrame, shown: DataFrame) -> DataFrame:
    """Figures that no problem shows."""
    live = live_lines(with_text(distinct_lines(rows)))
    return live.where(F.col("type").isin(*FIGURE_TYPES)).select("file", "page", F.col("idx").alias("fig")).join(shown.select("file", "fig").distinct(), ["file", "fig"], "left_anti")
