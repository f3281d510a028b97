"""The pipeline on a small table with awkward rows, stage by stage against what it has to do."""

import re

import corpus_pipeline as P
import pytest

from linefold.llm import secret_scan
from linefold.session import written


@pytest.fixture(scope="module")
def folder(spark, sf, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    item = bench.where("length(text) > 150").first()["text"]
    extra = [
        (9001, None, "en", "s", 0), (9002, "", None, None, 0), (9003, "12 34", "en", "s", 5),
        (9004, item, "en", "s", None), (9005, 'clean words stay here token = "0123456789abcdef0123456789abcdef" and after', "en", "s", 1),
        (9006, "clean words of a kind", "en", "s", 1), (9006, "clean words of a kind", "en", "s", 1), (None, "a text without id", "en", "s", 1),
    ]
    docs.union(spark.createDataFrame(extra, docs.schema)).withColumnRenamed("source", "score").selectExpr("*", "'x' as component_id").write.parquet(f"{d}/documents.parquet")
    bench.write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cols, seen = docs.columns, {}
    for name, stage in P.STAGES:
        out = written(stage(spark, docs, folder), name)
        seen[name] = out
        if name != P.STAGES[-1][0]:
            assert out.columns == cols and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
            assert out.where("score is null or component_id != 'x'").where("doc_id < 9000").count() == 0
        docs = out
    ids = {name: [r[0] for r in df.select("doc_id").collect()] for name, df in seen.items()}
    assert not {9001, 9002, 9003} & set(ids["language_id"]) and 9004 in ids["language_id"]
    assert ids["near_dedup"].count(9006) == 1 and None in ids["near_dedup"]
    assert 9004 not in ids["decontamination"] and 9006 in ids["decontamination"]
    text = {r["doc_id"]: r["text"] for r in seen["secret_scan"].collect()}
    assert re.fullmatch(r"clean words stay here \[\w+\] and after", text[9005].replace('"', "")) and not any(secret_scan.base_spans(t) for t in text.values())
    assert sorted(map(str, ids["byte_bpe"])) == sorted(map(str, ids["secret_scan"])) and seen["byte_bpe"].where("not exact").count() == 0


def test_empty_table(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").limit(0).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
