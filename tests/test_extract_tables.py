"""What the extractor writes between its steps, and copies of lines across files."""

import random

from linefold.operators import extract as E
from tests.test_extract import BOOK, line


def test_texts_are_written_twice_at_most(spark, monkeypatch):
    made, keep = [], E.written
    monkeypatch.setattr(E, "written", lambda df, label: made.append((label, df.schema.simpleString())) or keep(df, label))
    problems, _, _ = E.extract(spark.createDataFrame(BOOK, E.LINES))
    assert problems.count() == 5
    assert [label for label, schema in made if "t:string" in schema.split("<")[-1] or ",t:string" in schema] == ["rows", "problems"]


def test_distinct_lines_against_loop(spark):
    rnd = random.Random(5)
    rows = []
    for k in range(400):
        r = list(line(rnd.choice("abc"), k, rnd.choice(["같다", "다르다", "", None]), rnd.choice([0, 10]), page=rnd.choice([1, None]), type=rnd.choice(["text", None])))
        r[11] = rnd.choice([r[11], (0.0, -0.0, 1.0, 1.0), None])
        rows.append(tuple(r))
    rows += rows[:30]  # whole copies, place in the file included
    df = spark.createDataFrame(rows, E.LINES)
    for per_file in (False, True):
        seen, want = set(), []
        for r in sorted(rows, key=lambda r: (r[0], r[4])):
            key = (r[7], r[9], r[11] and (r[11][0], r[11][1] + 0.0), r[1], r[0] if per_file else None)
            if r[9] and key in seen:
                continue
            seen.add(key)
            want.append((r[0], r[4]))
        assert sorted((r["file"], r["ord"]) for r in E.distinct_lines(df, per_file).collect()) == sorted(want)
