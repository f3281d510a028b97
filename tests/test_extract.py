"""The extractor on hand-made lines, and the segment rule against a loop."""

import random

import pytest
from pyspark.sql import functions as F

from linefold.operators import extract as E
from linefold.operators import grade as G


def line(file, ord_, text, y, page=1, type="text", subtype=None, x=120.0, h=20.0, id=None, parent=None, hidden=None, font=20.0, width=100.0):
    return (file, page, 1000.0, 1400.0, ord_, id, parent, type, subtype, text, None, (x, float(y), width, h), font, 0, ord_, hidden, 0.9)


BOOK = [
    line("a", 1, "문제 1 다음 식의 값을 구하시오.", 100),
    line("a", 2, "(1) 첫째", 130),
    line("a", 3, "", 140, type="diagram", h=50.0),
    line("a", 4, "다음 설명이다.", 200),
    line("a", 5, "문제 2", 400),
    line("a", 6, "그림과 같이 놓인 도형의 넓이를", 430),
    line("a", 7, "구하시오.", 460, subtype="continues_line_space"),
    line("a", 8, "(단, 원주율은 3이다.)", 490),
    line("a", 9, "다른 말이다.", 520),
    line("a", 10, "", 540, type="chart", h=30.0),
    line("a", 11, "3. 값을 구하시오.", 900),
    line("a", 12, "5 개이다", 930),
    line("a", 13, "보이지 않는 줄", 950, hidden=False),
    line("a", 14, "쪽 번호", 960, type="page_info"),
    line("a", 15, "단원", 1000, type="section_header"),
    line("a", 16, "예제 4 값을 구하시오.", 1050),
    line("a", 17, "풀이 이렇게 푼다.", 1080),
    line("a", 1, "문제 1 다음 식의 값을 구하시오.", 100),
    line("b", 1, "4. 수렴한다.", 100),
    line("b", 2, "문제 7 그래프를 그리시오.", 300),
]


@pytest.fixture(scope="module")
def book(spark):
    rows = spark.createDataFrame(BOOK, E.LINES)
    return [x.cache() for x in E.extract(rows)]


def test_problems(book):
    got = {(r["file"], r["name"], r["num"]): r for r in book[0].collect()}
    assert set(got) == {("a", "문제", 1), ("a", "문제", 2), ("a", "번호점", 3), ("a", "예제", 4), ("b", "문제", 7)}
    assert got["a", "문제", 1]["reason"] == "본문종료" and got["a", "문제", 1]["lines"] == 3
    assert got["a", "문제", 2]["reason"] == "본문종료" and got["a", "문제", 2]["lines"] == 4
    assert got["a", "예제", 4]["reason"] == "풀이시작"
    assert got["b", "문제", 7]["reason"] == "다음문제"


def test_figures(book):
    problems, _, shown = book
    by = {(r["file"], r["start"], r["how"]) for r in shown.collect()}
    start = {(r["file"], r["num"]): r["start"] for r in problems.collect()}
    assert ("a", start["a", 1], "body") in by
    assert ("a", start["a", 2], "near") in by
    uses = shown.groupBy("file", "fig").count().agg(F.max("count")).first()[0]
    assert uses <= 2


def test_segments_are_disjoint(book):
    assert book[1].groupBy("file", "idx").count().where("count > 1").count() == 0


def loop_end(rows, kinds, max_lines, max_pages):
    seen, page, turns = rows[0]["order_end"], rows[0]["page"], 0
    for at, r in enumerate(rows[1:], 1):
        if r["page"] != page:
            turns, page = turns + 1, r["page"]
            if turns > max_pages:
                return at, "페이지초과"
        if r["is_head_line"]:
            return at, "단원제목"
        if seen and r["far"]:
            return at, "간격"
        if at >= max_lines:
            return at, "길이초과"
        if r["passive"]:
            continue
        if r["joined"] and not r["far"]:
            seen = seen or r["order_end"]
            continue
        if (seen and r["rider"]) or r["sub"]:
            continue
        if r["kind"] in kinds and r["solution"]:
            return at, "풀이시작"
        if seen:
            return at, "본문종료"
        seen = r["order_end"]
    return len(rows), "다음문제"


def test_segment_exits_against_loop(spark):
    rnd = random.Random(3)
    rows, want = [], {}
    flags = ["is_head_line", "far", "passive", "joined", "order_end", "rider", "sub", "solution"]
    for seg in range(400):
        kind, page, own = rnd.choice("AB"), 1, []
        for i in range(rnd.randint(1, 12)):
            page += rnd.random() < 0.15
            own.append({"g": seg, "start": 0, "idx": i, "page": page, "kind": kind} | {f: rnd.random() < (0.08 if f == "is_head_line" else 0.3) for f in flags})
        rows += own
        want[seg] = loop_end(own, ["A"], 8, 1)
    schema = "g long, start long, idx long, page int, kind string, " + ", ".join(f"{f} boolean" for f in flags)
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    got = {r["g"]: (r["end"], r["reason"]) for r in E.segment_exits(df, ["g"], ["A"], 8, 1).collect()}
    assert got == want


def test_score(spark):
    texts = ["다음 방정식의 해를 모두 구하시오", "함수의 극한값을 차례로 계산하시오", "직선과 평면의 관계를 설명하시오", "두 벡터의 내적을 구하시오"]
    refs = spark.createDataFrame([("t", i, t) for i, t in enumerate(texts)], "tag string, idx long, text string")
    exts = spark.createDataFrame([("t", 0, texts[0]), ("t", 1, texts[1][:12]), ("t", 2, "전혀 상관없는 문장이 여기에 놓여 있다"), ("t", 3, texts[3])], "tag string, idx long, text string")
    s = G.score(refs, exts).first()
    assert (s["exact"], s["truncated"], s["missed"], s["false"], s["in_scope"]) == (2, 1, 1, 1, 4)
    assert s["accuracy"] == 0.5 and s["false_rate"] == 0.25
