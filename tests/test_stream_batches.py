"""Streams over more files than a trigger takes, not laid out in time order, against the same rows in one batch."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.plans import catalogue


def test_many_files_in_shuffled_order(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(70, F.xxhash64("event_id")).sortWithinPartitions(F.xxhash64("event_id", "ts")).write.option("maxRecordsPerFile", 10).parquet(f"{tmp_path}/events.parquet")
    e = spark.read.parquet(f"{tmp_path}/events.parquet")
    assert len(e.inputFiles()) > 64 and e.count() == events.count()
    run = lambda name: sorted(map(tuple, catalogue.QUERIES[name](spark, str(tmp_path)).collect()))
    hours = F.unix_micros(F.date_trunc("hour", F.col("ts").cast("timestamp"))).alias("start_us")
    assert run("str9_tumbling") == sorted(map(tuple, e.groupBy(hours, "event_type").count().collect()))
    two = e.select(hours, "event_type").select(F.explode(F.array("start_us", F.col("start_us") - 3_600_000_000)).alias("start_us"), "event_type")
    assert run("str10_sliding") == sorted(map(tuple, two.groupBy("start_us", "event_type").count().collect()))
    p = F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id"))
    falls = e.withColumn("p", p).groupBy("user_id").agg(F.count_if(F.col("value") < F.col("p")))
    assert run("str5_out_of_order") == sorted(map(tuple, falls.collect()))
