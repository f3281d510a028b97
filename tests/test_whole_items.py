"""Verbatim search of many items, short ones among them, against a plain loop."""

from linefold.operators import verbatim
from linefold.plans import catalogue


def test_items_in_one_block_and_in_many(spark, tmp_path, monkeypatch):
    bodies = ["unbroken words stay here\nand there", "second text ends", "", None]
    items = ["broken", "broken wor", "oken words st", "here\nand", "ends", "d", "absent", "broken xor", "words stay here\nand", "ken words stay he", "text begins now or never", ""]
    spark.createDataFrame(list(enumerate(bodies)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([*enumerate(items), (99, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    missed = {i for i, t in enumerate(items) if not any(t in b for b in bodies if b is not None)} | {99}
    for most in (1_000_000, 20, 1):
        monkeypatch.setattr(verbatim, "MOST_CHARS", most)
        assert {r[0] for r in catalogue.QUERIES["jon6_missed"](spark, str(tmp_path)).collect()} == missed


def test_repeated_items_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, "one two"), (3, None)], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame([(1, "e t"), (2, "e t"), (3, "e  t"), (4, None), (5, "one two")], "item_id long, text string")
    got = verbatim.held(items, "item_id", "text", docs, "text").collect()
    assert sorted(r[0] for r in got) == [1, 2, 5]
    assert verbatim.held(items.limit(0), "item_id", "text", docs, "text").count() == 0
    assert verbatim.held(items, "item_id", "text", docs.limit(0), "text").count() == 0
