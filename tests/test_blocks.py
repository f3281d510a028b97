"""Matching blocks against difflib, and the spread of the work over tasks."""

import random
import time
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from linefold.operators import blocks, matching


def by_difflib(a, b):
    return sum(x.size for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())


@pytest.mark.parametrize("most", [blocks.MOST_PAIRS, 300, 20])
@pytest.mark.parametrize("letters", ["ab", "abcdefgh ", "가나다\U0001f600\ud800 xyz", "a"])
def test_as_difflib(letters, most):
    rnd = random.Random(len(letters) + most)
    for _ in range(60):
        a = "".join(rnd.choice(letters) for _ in range(rnd.randrange(120)))
        b = "".join(rnd.choice(letters) for _ in range(rnd.randrange(120)))
        if rnd.random() < 0.5:
            b = b[:30] + a[10:60] + b[30:] + a[:40]
        assert blocks.matched(a, b, most) == by_difflib(a, b)


def test_no_common_pair_of_characters():
    rnd = random.Random(1)
    for _ in range(50):
        a, b = ("".join(rnd.choice("abcdefgh") + sep for _ in range(60)) for sep in "12")
        assert blocks.matched(a, b) == by_difflib(a, b)


def test_faster_than_difflib_and_on_all_cores(spark):
    rnd = random.Random(7)
    text = lambda: " ".join("".join(rnd.choice("etaoinshr") for _ in range(rnd.randrange(2, 8))) for _ in range(200))
    rows = [(text(), text()) for _ in range(30)]

    def seconds(made):
        began = time.time()
        assert [made(a, b) for a, b in rows] and True
        return time.time() - began

    assert 2 * seconds(matching.matched_share) < seconds(by_difflib)
    pairs = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    found = matching.overlap(pairs, "a", "b").withColumn("task", F.spark_partition_id()).collect()
    assert len({r["task"] for r in found}) >= spark.sparkContext.defaultParallelism
    assert sorted((r["a"], r["recall"]) for r in found) == sorted((a, by_difflib(a, b) / len(a)) for a, b in rows)
