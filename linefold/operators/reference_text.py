"""Numbered reference problems out of page texts.

Input: (file, page, text), one row a page, pages from 1.  Lines, repeated page
heads, the start of the solutions, sections and clean-up are DataFrame work;
Python only finds patterns with their offsets and picks the number chain, per
file, each a book of bounded size.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.functions.text import mask_digits, strip
from linefold.operators import matching, ordered

# Patterns of page texts.
PAGE_MARK = r"(?U)^\s*[|\-–—]?\s*\d{1,4}\s*[|\-–—]?\s*$"
SOLUTION_HEAD = r"(?U)\[?\s*\]?\s*(정답 및 해설|빠른 정답)\s*\]?"
NUMBERED = (
    r"(?<![\d.])(?:(\d(?:\s?\d){0,2})\s*\.\s?)?(\d(?:\s?\d){0,2})\s*\)"
    r"|(?<![\d.])(\d(?:\s?\d){0,2})\s*\.\s?(\d(?:\s?\d){0,2})\s*\.(?!\d)"
)
SECTION_AFTER = r"(\d+-\d+-\d+)\.\s*([가-힣A-Za-z][^\d]{0,28})"
SECTION_BEFORE = r"([가-힣][^\d|]{0,28}?)(\d+-\d+-\d+)\."
SECTION_ANY = r"\d+-\d+-\d+\."
TITLE_TAIL = r"(?U)(시오|보자|하라|한다|이다|구하라|같다)\s*[.．]?$"
GLUED = r"\.(?=(\d{1,3})\.\1\))"
# Labels of blocks, in order.
BLOCK_LABELS = ["기초 문제", "기본 문제", "심화 문제", "서술형", "사고력 UP", "중단원 마무리", "대단원 마무리", "스스로 확인하기", "스스로 마무리하기", "생각 키우기", "생각을 넓히는 수학"]
# What is taken off the end of a problem, in order.
TAIL_BEFORE = [(r"(?U)\s*\d+-\d+-\d+\.\s*[^\d]{0,30}$", ""), (r"(?U)\s*[가-힣][^\d|]{0,28}?\d+-\d+-\d+\.\s*$", "")]
TAIL_LABELS = [(r"(?U)\s*\[?\Q" + x + r"\E\]?\s*$", "") for x in BLOCK_LABELS]
PUBLISHERS = ["비상", "미래엔", "천재", "동아", "지학사", "금성", "신사고", "좋은책신사고", "교학사", "능률", "YBM"]
TAIL_AFTER = [
    (r"(?U)\s*\[[가-힣A-Za-z·+ ]{2,14}\]\s*$", ""),
    (r"(?U)\s*(" + "|".join(PUBLISHERS) + r")\s*(수학|미적분|확률과 ?통계|기하)?\s*[0-9ⅠⅡIＩ]{0,2}\s*$", ""),
]
TABLE_TAIL = r"(?U)(?<=[.．])\s*[가-힣 -]*합계[가-힣 -]*$"
TAIL_LAST = [(r"(?U)(?<=[.．])\s*[가-힣 ]{0,20}※.*$", ""), (r"(?U)(?<=[시라자다까오][.．])\s*[가-힣 ]{2,14}$", ""), (r"(?U)\s*[가-힣 ]{0,8}내신대비.*$", "")]

BOILER_SHARE, SOLUTION_SHARE = 0.4, 0.4


def kept_lines(pages: DataFrame) -> DataFrame:
    """file, page, pos, line without blank lines and page numbers."""
    t = F.regexp_replace(F.coalesce("text", F.lit("")), r"\r\n?|\x0B|\f", "\n")
    one = pages.select("file", "page", F.posexplode(F.split(t, "\n", -1)).alias("pos", "line")).withColumn("line", strip("line"))
    return one.where((F.col("line") != "") & ~F.col("line").rlike(PAGE_MARK))


def boilerplate(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """file, masked, n, sample: masked lines on enough pages of their file."""
    size = pages.groupBy("file").agg(F.greatest(F.lit(2), F.floor(F.count("*") * BOILER_SHARE)).alias("least"))
    d = lines.where((F.length("line") >= 4) & F.col("line").rlike("[가-힣A-Za-z]")).groupBy("file", "page", "line").agg(F.min("pos").alias("pos"))
    n = d.groupBy("file", mask_digits("line").alias("masked")).agg(F.count("*").alias("n"), F.min(F.struct("page", "pos", "line"))["line"].alias("sample"))
    return n.join(size, "file").where("n >= least").drop("least")


def _numbers(line):
    """Numbers of the pattern's second or fourth group, blanks taken out."""
    both = F.zip_with(F.regexp_extract_all(line, F.lit(NUMBERED), F.lit(2)), F.regexp_extract_all(line, F.lit(NUMBERED), F.lit(4)), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    return F.transform(both, lambda x: F.regexp_replace(x, r"\s", "").try_cast("int"))


def solution_page(lines: DataFrame, pages: DataFrame) -> DataFrame:
    """file, solution_page, how: a heading, else the first page where numbers restart for good."""
    headed = lines.where(F.col("line").rlike(SOLUTION_HEAD)).groupBy("file").agg(F.min("page").alias("headed"))
    nums = lines.select("file", "page", _numbers(F.col("line")).alias("v")).groupBy("file", "page").agg(F.flatten(F.collect_list("v")).alias("v"))
    p = pages.select("file", "page").join(nums, ["file", "page"], "left").withColumn("v", F.coalesce("v", F.array().cast("array<int>")))
    w = Window.partitionBy("file").orderBy("page")
    p = p.withColumn("place", F.row_number().over(w) - 1).withColumn("n", F.count("*").over(Window.partitionBy("file"))).withColumn("top", F.array_max("v"))
    p = p.withColumn("seen", F.coalesce(F.max("top").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    p = p.withColumn("ahead", F.max("top").over(w.rowsBetween(0, 2)))
    again = (F.col("seen") >= 20) & (F.array_min("v") <= 3) & (F.size(F.filter("v", lambda x: x <= 10)) >= 2) & (F.col("ahead") < F.col("seen") - 5) & (F.col("place") >= F.col("n") * SOLUTION_SHARE)
    restart = p.where(again).groupBy("file").agg(F.min("page").alias("restart"))
    out = pages.select("file").distinct().join(headed, "file", "left").join(restart, "file", "left")
    how = F.when(F.col("headed").isNotNull(), "표기").when(F.col("restart").isNotNull(), "번호재시작")
    return out.select("file", F.coalesce("headed", "restart").alias("solution_page"), how.alias("how"))


def find_all(df: DataFrame, pattern: str) -> DataFrame:
    """(file, start, end, groups) of every match in (file, stream): offsets, which column functions do not give."""
    find = re.compile(pattern).finditer

    def run(frames):
        for f in frames:
            rows = [(name, m.start(), m.end(), list(m.groups())) for name, s in zip(f["file"], f["stream"]) for m in find(s)]
            yield pd.DataFrame(rows, columns=["file", "start", "end", "groups"])

    return df.select("file", "stream").mapInPandas(run, "file string, start long, end long, groups array<string>")


def streams(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file, stream) of all pages' lines joined by blanks, and (file, start, page) of each page in it."""
    chunk = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ").alias("chunk")
    c = lines.groupBy("file", "page").agg(chunk)
    before = Window.partitionBy("file").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    at = c.withColumn("start", F.coalesce(F.sum(F.length("chunk") + 1).over(before), F.lit(0)))
    whole = c.groupBy("file").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("page", "chunk"))), lambda x: x["chunk"]), " ").alias("stream"))
    head = F.regexp_instr("stream", F.lit(SOLUTION_HEAD))
    whole = whole.withColumn("stream", F.when(F.col("stream").rlike(SOLUTION_HEAD), F.substring(F.col("stream"), F.lit(1), head - 1)).otherwise(F.col("stream")))
    return whole.withColumn("stream", F.regexp_replace("stream", GLUED, " ")), at.select("file", "start", "page")


def is_title(line):
    return F.length(line).between(2, 24) & ~line.rlike(r"\d") & line.rlike("[가-힣]") & ~line.rlike(TITLE_TAIL) & ~line.rlike("[.．。?？!！,，]$")


def _one_of(t, words):
    return reduce(or_, [F.contains(t, F.lit(w)) for w in words])


def _tail_steps() -> list[tuple]:
    """Patterns of the clean-up in order, each with a test for what every match holds: plain words, found far faster than a pattern fails."""
    sections = [(p, lambda t: F.contains(t, F.lit("-")) & t.rlike(r"(?U)\d-\d")) for p, _ in TAIL_BEFORE]
    labels = [(p, lambda t, x=x: F.contains(t, F.lit(x))) for (p, _), x in zip(TAIL_LABELS, BLOCK_LABELS)]
    # a bracket ends the text; a publisher stands among its last characters or before blanks and digits
    after = [(TAIL_AFTER[0][0], lambda t: F.rtrim(t).endswith("]")), (TAIL_AFTER[1][0], lambda t: _one_of(t, PUBLISHERS))]
    table = [(TABLE_TAIL, lambda t: F.contains(F.right(t, F.lit(60)), F.lit("합계")))]
    last = [(TAIL_LAST[0][0], lambda t: F.contains(t, F.lit("※"))), (TAIL_LAST[1][0], lambda t: _one_of(t, ".．") & F.right(t, F.lit(1)).rlike("[가-힣 ]")), (TAIL_LAST[2][0], lambda t: F.contains(t, F.lit("내신대비")))]
    return sections + labels + after + table + last


def clean_tail(text):
    # only runs that are not one plain blank change
    t = F.trim(F.regexp_replace(text, r"(?U) \s+|[\s&&[^ ]]\s*", " "))
    held = F.array(t)  # a lambda's argument is computed once, however often a step names it
    for pattern, can in _tail_steps():
        held = F.transform(held, lambda x: F.when(can(x), F.regexp_replace(x, pattern, "")).otherwise(x))  # noqa: B023
    return F.get(held, F.lit(0))


def label_in(tail):
    """The block label that a text holds; of several the last listed."""
    return F.coalesce(*[F.when(F.contains(tail, F.lit(x)), x) for x in reversed(BLOCK_LABELS)])


def parse(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(problems, documents).  problems: file, idx, num, display, section, block, page, text, head, chars."""
    lines = kept_lines(pages)
    boiler = boilerplate(lines, pages)
    lines = lines.withColumn("masked", mask_digits("line")).join(boiler.select("file", "masked"), ["file", "masked"], "left_anti")
    sol = solution_page(lines, pages)
    body = lines.join(sol, "file", "left").where(F.col("solution_page").isNull() | (F.col("page") < F.col("solution_page")))
    whole, page_at = streams(body)
    found = find_all(whole, NUMBERED)
    number = lambda c: F.regexp_replace(c, r"\s", "").cast("long")
    g = lambda k: F.element_at("groups", k)
    cands = found.select("file", "start", "end", number(F.coalesce(g(2), g(4))).alias("num"), number(F.coalesce(g(1), g(3))).alias("display"))
    cands = ordered.numbered(cands, ["file"], ["start"]).withColumn("shown", F.coalesce("display", F.lit(-1)))
    starts = cands.join(matching.chains(cands, "file").select("file", "idx"), ["file", "idx"])
    starts = starts.withColumn("next", F.lead("start").over(Window.partitionBy("file").orderBy("start")))

    after = find_all(whole, SECTION_AFTER).select("file", "start", F.struct(F.lit(1).alias("rank"), F.concat(g(1), F.lit(". "), strip(g(2))).alias("name")).alias("section"))
    ahead = find_all(whole, SECTION_BEFORE).select("file", "start", F.struct(F.lit(0).alias("rank"), F.concat(g(2), F.lit(". "), strip(g(1))).alias("name")).alias("section"))
    by_number = whole.select("file", (F.regexp_count("stream", F.lit(SECTION_ANY)) >= 3).alias("by_number"))
    titles = body.withColumn("k", F.row_number().over(Window.partitionBy("file", "page").orderBy("pos"))).where((F.col("k") <= 2) & is_title(F.col("line")))
    titles = titles.groupBy("file", "page").agg(F.min(F.struct("pos", "line"))["line"].alias("title"))

    p = ordered.asof(starts, page_at, ["file"], "start", "start", "page")
    p = ordered.asof(p, after.unionByName(ahead), ["file"], "start", "start", "section", strict=True)
    p = ordered.asof(p, titles, ["file"], "page", "page", "title")
    p = p.join(by_number, "file").join(whole, "file")
    tail = F.substring(F.col("stream"), F.greatest(F.lit(1), F.col("start") - 119).cast("int"), F.least(F.lit(120), F.col("start")).cast("int"))
    block = label_in(tail)
    raw = F.substring(F.col("stream"), (F.col("end") + 1).cast("int"), (F.coalesce("next", F.length("stream").cast("long")) - F.col("end")).cast("int"))
    text = clean_tail(raw)
    problems = p.select(
        "file", "idx", "num", "display", F.when(F.col("by_number"), F.col("section.name")).otherwise(F.col("title")).alias("section"), block.alias("block"), F.coalesce("page", F.lit(1)).alias("page"), text.alias("text")
    )
    problems = problems.withColumn("head", F.substring("text", 1, 100)).withColumn("chars", F.length("text"))
    shown = boiler.groupBy("file").agg(F.transform(F.sort_array(F.collect_list(F.struct((-F.length("sample")).alias("n"), "sample"))), lambda x: x["sample"]).alias("boilerplate"))
    docs = pages.groupBy("file").agg(F.count("*").alias("pages")).join(sol, "file", "left").join(by_number, "file", "left").join(shown, "file", "left")
    return problems, docs
