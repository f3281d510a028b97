"""Places within groups that no single task may hold."""

import random

import pytest
from pyspark.sql import functions as F

from linefold.operators import ordered
from linefold.plans import groups  # noqa: F401  registers srt1


@pytest.fixture
def rows(spark):
    rnd = random.Random(2)
    out = [("hot", rnd.randrange(50), i) for i in range(3000)] + [(g, rnd.randrange(5) or None, i) for i in range(3000, 3300) for g in ("a", None, "")]
    out += [("hot", 7, 1)] * 1500 + [("hot", None, None)] * 20
    return out


def test_places_of_hot_groups_ties_and_nulls(spark, rows):
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(5)
    by = [F.col("v").asc_nulls_last(), F.col("id").desc_nulls_first()]
    got = ordered.numbered_wide(df, ["g"], by, "place")
    want = ordered.numbered(df, ["g"], by, "place")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_no_task_numbers_a_whole_group(spark, rows):
    """The rows that one (group, range) holds stay near an even share, even if half a group is one value."""
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(5)
    got = ordered.numbered_wide(df, ["g"], ["v", "id"], "place")
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan.split("windowspecdefinition", 1)[1].split(")")[0]
    ranges = spark.read.parquet(next(f.rsplit("/", 1)[0] for f in got.inputFiles() if "ranges" in f))
    largest = ranges.groupBy("g", "_range").count().agg(F.max("count")).first()[0]
    assert largest < 0.5 * len(rows)


def test_nothing_to_number(spark):
    assert ordered.numbered_wide(spark.createDataFrame([], "g string, v long"), ["g"], ["v"]).count() == 0
