"""Boundaries through a judge, package checks, feeds of one kind, folds in order."""

import io
import random
import zipfile

import pandas as pd

from linefold.operators import boundaries, matching, package_checks
from linefold.sources.pages import read_packages
from linefold.streaming import events


def test_blocks_stop_at_gaps_and_closed_lines():
    import numpy as np

    wide = np.array([False, False, True, False, False, True, False, True])
    closed = np.array([True, False, False, False, False, False, False, False])
    assert boundaries.neighbours(wide, closed, 4, -1) == [(2, 4), (1, 1)]
    assert boundaries.neighbours(wide, closed, 3, 1) == [(3, 4), (5, 6)]
    assert boundaries.neighbours(wide, closed, 8, 1) == [] == boundaries.neighbours(wide, closed, 0, -1)


def test_only_an_unbroken_choice_around_the_anchor_counts():
    assert boundaries.together("1, 2 and 4", 2, 4) == (1, 2)
    assert boundaries.together("1, 3", 2, 3) == (2, 2) == boundaries.together("", 2, 3)
    assert boundaries.together("1 2 3 99", 2, 3) == (1, 3)


def test_widened_lines_are_taken(spark):
    text = ["intro", "more", "TASK 1", "rest", "TASK 2", "풀이 is here", "![](x)", "TASK 3"]
    lines = pd.DataFrame({"f": "a", "idx": range(10, 18), "text": text, "gap": [None, 1, 9, 1, 1, 1, 9, 1], "head": False})
    problems = pd.DataFrame({"f": "a", "start": [12, 14, 17], "end": [12, 14, 17], "open": [True, True, True]})

    def ask(t):
        if "TASK 3" in t:
            raise ValueError
        return " ".join(str(k) for k in range(1, 1 + t.count("[")))

    got = boundaries.refine(spark.createDataFrame(lines), spark.createDataFrame(problems), "f", ask, 5.0).collect()
    # the first takes the lines on both sides, so the second has none left before it, and behind it only a solution
    assert sorted(map(tuple, got)) == [("a", 12, 10, 13, "widened"), ("a", 14, 14, 14, "as it is"), ("a", 17, 17, 17, "as it is")]
    assert boundaries.refine_file(lines.assign(text="x TASK 3"), problems, ask, 5.0)[0][3] == "failed"


def test_package_checks(spark, tmp_path):
    good = {
        "Contents/section0.xml": '<a xmlns:hp="x"><hp:tbl rows="2"/><hp:p charPrIDRef="1" paraPrIDRef="2" borderFillIDRef="3"/><hp:pic id="1" binaryItemIDRef="image1"/></a>',
        "Contents/header.xml": '<a xmlns:hh="y"><hh:charPr id="1"/><hh:paraPr id="2"/><hh:borderFill id="3"/></a>',
        "Contents/content.hpf": '<a xmlns:opf="z"><opf:item id="image1"/></a>',
        "BinData/image1.png": "x",
    }
    bad = good | {
        "Contents/section0.xml": '<a xmlns:hp="x"><hp:p charPrIDRef="7" linesegarray=""/><hp:pic binaryItemIDRef="image9"><hp:pos treatAsChar="1"/></hp:pic><hp:pic ></hp:pic><hp:script> </hp:script>'
        '<hp:equation id="1"><hp:sz width="99999"/></hp:equation></a>',
        "Contents/header.xml": "<open>",
    }
    for name, parts in (("good", good), ("bad", bad)):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            for part, body in parts.items():
                z.writestr(part, body)
    (tmp_path / "none.zip").write_bytes(io.BytesIO(b"no package").getvalue())
    rows = package_checks.checks(read_packages(spark, str(tmp_path))).collect()
    found = {n: {r["check"]: r["detail"] for r in rows if r["key"].endswith(f"/{n}.zip")} for n in ("good", "bad", "none")}
    assert found["good"] == {}
    assert found["bad"] == {
        "broken xml": "header.xml", "undefined charPrIDRef": "7", "pictures differ from media": "2 / 1", "picture not in manifest": "image9", "line coordinates": "linesegarray",
        "no layout": "neither two columns nor a table", "empty formula": "1", "formula wider than the column": "99999", "picture in the text flow": "1",
    }
    assert "broken xml" in found["none"]


def test_split_of_feeds_of_one_kind(spark, tmp_path):
    schema = "event_id long, user_id long, event_type string, ts timestamp, value double, props string"
    for name, rows in (("clean", [(1, 1, "view", None, 1.0, "{}")]), ("failed", [(1, 1, "error", None, 1.0, "{}")]), ("empty", [])):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / name / "events.parquet"))
        got = events.run_split(events.source(spark, str(tmp_path / name))).collect()
        assert [r["state"] for r in got] == {"clean": ["done"], "failed": ["error"], "empty": []}[name]


def test_folds_against_loops(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, None]), i, rnd.randrange(1, 6)) for i in range(400)]
    got = matching.disjoint(spark.createDataFrame(rows, "g long, idx long, n long").repartition(5), "g", "n").collect()
    want = []
    for g in (1, 2, None):
        free = -1
        for k, i, n in rows:
            if k == g and i >= free:
                want.append((g, i, n))
                free = i + n
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    raws = [(1, i, "a", r) for i, r in enumerate(["3", "41", "5", "x7", None, "68", "007", "12345678901234567890123"])]
    got = matching.repaired(spark.createDataFrame(raws, "g long, idx long, name string, raw string"), "g", "a").collect()
    assert [(r["idx"], r["num"], r["num_fixed"]) for r in sorted(got, key=lambda r: r["idx"])] == [
        (0, 3, False), (1, 4, True), (2, 5, False), (3, 6, True), (4, None, False), (5, 68, False), (6, 7, False), (7, None, False)
    ]


def test_all_files_are_widened_in_one_pass(spark):
    """Many small files are no calls of their own; long texts are cut before they are dealt; a file without problems gives no row."""
    lines = spark.range(60).selectExpr("id div 3 as f", "id % 3 as idx", "repeat('x', 1000) as text", "9.0D as gap", "false as head")
    problems = spark.range(1, 20).selectExpr("id as f", "1L as start", "1L as end", "true as open")
    got = boundaries.refine(lines, problems, "f", lambda text: "1 2" if len(text) < 1300 else "no", 5.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "CoGroup" not in plan
    assert sorted(map(tuple, got.collect())) == [(f, 1, 0, 1, "widened") for f in range(1, 20)]
