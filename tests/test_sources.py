"""Page JSON at any depth, file trees, and the optional paragraphs without a marker."""

import json
import zipfile

from linefold.operators import extract as E
from linefold.sources import pages as P
from tests.test_extract import BOOK, line


def test_pages_at_any_depth(spark, tmp_path):
    one = {"result": {"pages": [{"page": 3, "page_width": 0, "image_width": 800, "lines": [{"id": "x", "text": "가", "region": {"top_left_x": 1}}, {"text": "나", "line": "bad"}]}]}}
    two = [{"lines": [{"text": "다", "conversion_output": False}]}, {"lines": []}, {"deep": [{"page_idx": 9, "lines": [{"text": "라"}]}]}]
    for name, body in (("a", one), ("b", two)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "result.lines.json").write_text(json.dumps(body))
    got = {(r["file"], r["page"], r["text"], r["page_width"]) for r in P.read_lines(spark, str(tmp_path)).collect()}
    assert got == {("a", 3, "가", 800.0), ("a", 3, "나", 800.0), ("b", 1, "다", None), ("b", 9, "라", None)}
    assert {r["file"] for r in P.read_lines(spark, str(tmp_path), ["a"]).collect()} == {"a"}
    assert E.extract(P.read_lines(spark, str(tmp_path)))[0].count() == 0


def test_inventory(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, body in (("a.PDF", b"%PDF-1"), ("in/b.zip", b"PK\x03\x04x"), ("in/c.bin", b"%PDF-1"), ("e", b"")):
        (tmp_path / name).write_bytes(body)
    files = P.inventory(spark, str(tmp_path)).cache()
    assert {(r["name"], r["ext"], r["kind"]) for r in files.collect()} == {("a.PDF", "pdf", "pdf"), ("b.zip", "zip", "zip"), ("c.bin", "bin", "pdf")}
    assert [r["n"] for r in P.duplicate_files(files).collect()] == [2]


def test_packages(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x/section.xml", "<a/>")
        z.writestr("bin.dat", b"12")
    (tmp_path / "b.zip").write_bytes(b"nothing")
    got = {(r["path"][-5:], r["part"], bytes(r["content"] or b"")) for r in P.read_packages(spark, str(tmp_path)).collect()}
    assert got == {("a.zip", "x/section.xml", b"<a/>"), ("a.zip", "bin.dat", b"12"), ("b.zip", None, b"")}


def test_unmarked_paragraphs(spark):
    lines = BOOK[:9] + [line("a", 20 + k, f"표기가 없는 문단으로서 값을 구하시오. {k}", 1000 + 150 * k, page=2) for k in range(3)]
    rows = spark.createDataFrame(lines, E.LINES)
    assert E.extract(rows)[0].where("name = '지문'").count() == 0
    found = E.extract(rows, with_unmarked=True)[0]
    assert found.where("name = '지문' and num is null").count() == found.where("name = '지문'").count() >= 1
    assert found.where("name = '문제'").count() == 2
