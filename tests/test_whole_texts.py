"""Matched blocks and book lines over whole texts."""

import random
from difflib import SequenceMatcher

from linefold.plans import books, catalogue


def test_overlap_of_turns_over_400_characters(spark, tmp_path):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(6))
    same = " ".join(word() for _ in range(50))
    turns = [" ".join(word() for _ in range(70)) + " " + same, same + " " + " ".join(word() for _ in range(70)), "short"]
    rows = [(1, i, "user", t) for i, t in enumerate(turns)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["turn"]: (r["recall"], r["precision"]) for r in catalogue.QUERIES["mtc3_overlap"](spark, str(tmp_path)).collect()}
    for i, (a, b) in enumerate(zip(turns, turns[1:])):
        n = sum(x.size for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())
        assert got[i] == (round(n / len(a), 6), round(n / len(b), 6))
    assert len(got) == 2 and got[0][0] > 0.4


def test_book_lines_are_whole(spark, tmp_path):
    long = ["word " * 99 + f"end{i}" for i in range(4)]
    spark.createDataFrame([(1, "\n".join(long), "en")], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = [r[0] for r in books.book_lines(spark, str(tmp_path)).select("text").collect()]
    assert len(texts) == 4 and all(any(t in x for x in texts) for t in long)
