"""Structured Streaming over an event feed.

Each ``run_*`` drives a query over everything that is there (available-now
trigger) into a table in the shared folder and returns that table.  A query
that is restarted with the same checkpoint goes on where it stopped; files
that it finished are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linefold.session import shared_dir

PAYLOAD = "struct<k: long>"


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream of files; the feed's name is matched below its folder."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", 64).parquet(f"{sf_dir}/events.parquet*")


def parsed(events: DataFrame) -> DataFrame:
    return events.select("*", F.from_json("props", PAYLOAD).alias("p")).select("event_id", "user_id", "event_type", "ts", "value", "p.k")


def unparsed(events: DataFrame) -> DataFrame:
    """Payloads that do not parse, cut to 500 characters; here the error records' type stands for such a payload."""
    payload = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("props"))
    bad = F.try_parse_json(payload).isNull()
    return events.where(bad).select("event_id", F.substring(payload, 1, 500).alias("raw"))


def latest(events: DataFrame) -> DataFrame:
    return events.groupBy("user_id").agg(F.max(F.struct("event_id", "value")).alias("x")).select("user_id", "x.*")


def summary(events: DataFrame) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.groupBy("event_type").agg(F.min(us).alias("first_us"), F.max(us).alias("last_us"), F.count("*").alias("n"))


def tumbling(events: DataFrame, length: str, slide: str | None = None) -> DataFrame:
    """Counts of windows; without a watermark, as files may come in any order of time, so the state holds all windows of the feed."""
    e = events.withColumn("at", F.col("ts").cast("timestamp"))
    n = e.groupBy(F.window("at", length, slide), "event_type").agg(F.count("*").alias("n"))
    return n.select(F.unix_micros("window.start").alias("start_us"), "event_type", "n")


def run_split(events: DataFrame) -> DataFrame:
    """Each batch into a table of done rows and one of error rows, whose union is returned."""
    spark = events.sparkSession
    base = shared_dir(spark, "split")
    rows = events.select("event_id", F.when(F.col("event_type") == "error", "error").otherwise("done").alias("state"))

    def save(batch: DataFrame, number: int) -> None:
        batch.persist()
        for x in ("done", "error"):  # both, so that a feed without errors has a table of none
            batch.where(F.col("state") == x).write.mode("overwrite").parquet(f"{base}/{x}/part_{number}")
        batch.unpersist()

    rows.writeStream.foreachBatch(save).option("checkpointLocation", f"{base}/log").trigger(availableNow=True).start().awaitTermination()
    done, failed = (spark.read.schema("event_id long, state string").parquet(f"{base}/{x}/part_*") for x in ("done", "error"))
    return done.unionByName(failed)


def run_log(events: DataFrame) -> DataFrame:
    """Appended JSON lines with either the parsed fields or the payload's text."""
    spark = events.sparkSession
    base = shared_dir(spark, "log")
    payload = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("props"))
    ok = F.try_parse_json(payload).isNotNull()
    rows = events.select("event_id", F.when(ok, F.from_json(payload, PAYLOAD)["k"]).alias("k"), F.when(~ok, F.substring(payload, 1, 500)).alias("unparsed"))
    q = rows.writeStream.format("json").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start(f"{base}/out")
    q.awaitTermination()
    return spark.read.schema("event_id long, k long, unparsed string").json(f"{base}/out")


def run_append(out: DataFrame) -> DataFrame:
    spark = out.sparkSession
    base = shared_dir(spark, "stream")
    q = out.writeStream.format("parquet").option("checkpointLocation", f"{base}/state").outputMode("append").trigger(availableNow=True).start(f"{base}/out")
    q.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{base}/out")


def run_upsert(out: DataFrame, key: list[str]) -> DataFrame:
    """Update mode: each batch's changed rows are written under its number (a repeated batch overwrites itself); the last of a key counts."""
    spark = out.sparkSession
    base = shared_dir(spark, "stream")

    def save(batch: DataFrame, number: int) -> None:
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{base}/out/part_{number}")

    q = out.writeStream.foreachBatch(save).option("checkpointLocation", f"{base}/state").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    schema = out.schema.add("_batch", "integer")
    rows = spark.read.schema(schema).parquet(f"{base}/out/part_*")
    last = Window.partitionBy(*key).orderBy(F.desc("_batch"))
    return rows.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k", "_batch")
