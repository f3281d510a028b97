"""Kept results: only new and changed files are read again, broken runs count for nothing."""

import os

from pyspark.sql import functions as F

from linefold.sources import reuse


class Store:
    def __init__(self, spark, tmp):
        self.spark, self.files, self.store = spark, tmp / "in", f"file://{tmp}/store"
        self.files.mkdir()
        self.read = spark.sparkContext.accumulator(0)

    def put(self, name, text):
        (self.files / name).write_text(text)

    def parse(self, files):
        read = self.read

        def words(t):
            read.add(1)
            return len(t.split())

        n = F.udf(words, "int")
        return reuse.opened(files).select("path", n(F.decode("content", "utf-8")).alias("words"))

    def run(self, version="1"):
        before = self.read.value
        rows, n = reuse.reused(reuse.file_stamps(self.spark, f"file://{self.files}"), "path", ["length", "time"], self.parse, self.store, version)
        return {r["path"].rsplit("/", 1)[1]: (r["words"], r["run"]) for r in rows.collect()}, n, self.read.value - before


def test_only_changed_files_are_read(spark, tmp_path):
    s = Store(spark, tmp_path)
    for k in range(12):
        s.put(f"f{k}", "w " * (k + 1))
    rows, n, read = s.run()
    assert n == read == 12 and rows == {f"f{k}": (k + 1, 0) for k in range(12)}
    assert s.run() == (rows, 0, 0)  # nothing is read, the same rows come out
    s.put("f3", "w " * 50)
    s.put("new", "one")
    os.remove(s.files / "f5")
    rows, n, read = s.run()
    assert n == read == 2 and rows["f3"] == (50, 2) and rows["new"] == (1, 2) and "f5" not in rows
    assert {k: v[0] for k, v in rows.items()} == {p.name: len(p.read_text().split()) for p in s.files.iterdir()}  # as a full run
    assert s.run("2")[1:] == (12, 12)  # another parser


def test_a_run_that_broke_is_not_read(spark, tmp_path):
    s = Store(spark, tmp_path)
    s.put("a", "x y")
    rows, _, _ = s.run()
    spark.createDataFrame([("zzz", 9)], "path string, words int").write.parquet(f"{s.store}/rows/run=1")
    spark.createDataFrame([("zzz", "m", 1)], "key string, mark string, run int").write.parquet(f"{s.store}/manifest/run=1")
    os.remove(f"{tmp_path}/store/manifest/run=1/_SUCCESS")
    assert s.run()[0] == rows
