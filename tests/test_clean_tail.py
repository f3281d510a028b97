"""The clean-up of a problem's end against its plain steps."""

import random
import time

from pyspark.sql import functions as F

from linefold.functions.text import scrub, strip
from linefold.operators import reference_text as R
from linefold.plans.reference import TAILS


def plain(text):
    t = strip(F.regexp_replace(text, r"(?U)\s+", " "))
    t = scrub(t, R.TAIL_BEFORE + R.TAIL_LABELS + R.TAIL_AFTER)
    t = F.when(F.contains(F.right(t, F.lit(60)), F.lit("합계")), F.regexp_replace(t, R.TABLE_TAIL, "")).otherwise(t)
    return scrub(t, R.TAIL_LAST)


def test_every_step_as_before(spark):
    rnd = random.Random(2)
    parts = [*TAILS, *R.BLOCK_LABELS, *R.PUBLISHERS, " ", " ", "  ", "\n", "\x85", "] ", "[", ".", "시．", "가", "-", "١-٢-٣.", "※", "합계", "내신대비", "word", "12"]
    rows = [("".join(rnd.choice(parts) for _ in range(rnd.randrange(9))),) for _ in range(3000)] + [(None,), ("",)]
    got = spark.createDataFrame(rows, "text string").select("text", R.clean_tail(F.col("text")).alias("new"), plain(F.col("text")).alias("old"))
    assert got.where("not (new <=> old)").collect() == []


def test_texts_without_a_tail_are_not_searched_by_every_pattern(spark):
    df = spark.createDataFrame([("가나다라 마바사 아자차 word " * 200 + "끝이다.",)] * 200, "text string").repartition(2).cache()
    df.count()

    def seconds(made):
        times = []
        for _ in range(2):
            began = time.time()
            df.select(made(F.col("text")).alias("text")).write.format("noop").mode("overwrite").save()
            times.append(time.time() - began)
        return min(times)

    assert 2 * seconds(R.clean_tail) < seconds(plain)
