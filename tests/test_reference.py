"""Reference parsing and diagnosis on hand-made pages and lines."""

import pytest
from pyspark.sql import functions as F

from linefold.operators import diagnose as D
from linefold.operators import extract as E
from linefold.operators import reference_text as R
from tests.test_extract import BOOK, line

PAGES = [
    (1, "수학 교과서 1\n순열의 뜻\n1.1) 다음 값을 구하시오. 2.2) 순열의 수를 구하시오. 순열과 조합\n- 1 -"),
    (2, "수학 교과서 2\n기본 문제\n3.3) 빈칸을 채우시오. [공학적 도구]\n4) 해를 구하\n시오."),
    (3, "수학 교과서 3\n5.5) 넓이를 구해 보자.6.6) 부피를 구하시오. 비상 수학1"),
    (4, "수학 교과서 4\n정답 및 해설\n1) 풀이 2) 풀이"),
]


@pytest.fixture(scope="module")
def parsed(spark):
    pages = spark.createDataFrame([("book", p, t) for p, t in PAGES], "file string, page int, text string")
    problems, docs = R.parse(pages)
    return {r["num"]: r for r in problems.collect()}, docs.first()


def test_numbers_texts_and_pages(parsed):
    got, _ = parsed
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert got[1]["text"] == "다음 값을 구하시오." and got[2]["text"] == "순열의 수를 구하시오."
    assert got[3]["text"] == "빈칸을 채우시오." and got[4]["text"] == "해를 구하 시오." and got[4]["display"] is None
    assert got[6]["text"] == "부피를 구하시오." and [got[i]["page"] for i in (1, 2, 3, 4, 5, 6)] == [1, 1, 2, 2, 3, 3]
    assert got[3]["block"] == "기본 문제" and got[1]["section"] == "순열의 뜻"


def test_document_facts(parsed):
    doc = parsed[1]
    assert (doc["pages"], doc["solution_page"], doc["how"], doc["by_number"]) == (4, 4, "표기", False)
    assert doc["boilerplate"] == ["수학 교과서 1"]


def test_solutions_by_restart(spark):
    rows = [("b", p, " ".join(f"{n}) 문제" for n in range(5 * p - 4, 5 * p + 1))) for p in range(1, 9)] + [("b", 9, "1) 가 2) 나 3) 다"), ("b", 10, "4) 라 5) 마")]
    pages = spark.createDataFrame(rows, "file string, page int, text string")
    assert tuple(R.solution_page(R.kept_lines(pages), pages).first()) == ("b", 9, "번호재시작")


def test_sections_by_number(spark):
    text = "1-1-1. 가나다 1.1) 문제를 푸시오. 1-1-2. 라마바 2.2) 값을 구하시오. 사아자1-1-3. 3.3) 해를 구하시오."
    problems, docs = R.parse(spark.createDataFrame([("b", 1, text)], "file string, page int, text string"))
    assert {r["num"]: r["section"][:5] for r in problems.collect()} == {1: "1-1-1", 2: "1-1-2", 3: "1-1-3"} and docs.first()["by_number"]


def test_diagnosis(spark):
    extra = [line("a", 30, "", 20, page=7, type="diagram"), line("a", 31, "", 1390, page=1, type="diagram", width=100.0)]
    rows = spark.createDataFrame(BOOK + extra, E.LINES)
    problems, bridge, shown = E.extract(rows)
    orphans = E.orphan_figures(rows, shown)
    kinds = {r["page"]: r["kind"] for r in D.orphan_kinds(orphans, problems, bridge).collect()}
    assert kinds[7] == "문제없는쪽" and kinds[1] in ("문제뒤", "문제사이")
    live = E.live_lines(E.with_text(E.distinct_lines(rows)))
    live = live.withColumn("m", E.marker_of(F.col("t"), F.col("font_size"))).withColumn("line_id", F.col("ord") + F.when(F.col("file") == "b", 1000).otherwise(0))
    missed = spark.createDataFrame([(1, "그림과 같이 놓인 도형의 넓이를"), (2, "전혀 없는 문장입니다 정말로"), (3, "수렴한다")], "ref_id long, head string")
    why = {r["ref_id"]: r["why"] for r in D.why_missed(missed, live, bridge, problems.select("file", F.col("start").alias("idx"))).collect()}
    assert why == {1: "흡수됨", 2: "원본에없음", 3: "표기있음"}
    state = {r["file"]: r for r in D.file_state(live, problems).collect()}
    assert state["a"]["problems"] == 4 and state["b"]["problems"] == 1
