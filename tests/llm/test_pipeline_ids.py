"""Rows without an id and rows of a repeated id in the pipeline's near-duplicate stage."""

import corpus_pipeline as P

from linefold.llm import near_dedup


def test_null_ids_stay_and_the_compared_text_survives(spark):
    a, b = "one two three four five six", "quite other words are here now"
    rows = [(None, "a text without id"), (None, "another text, also without id"), (None, None), (5, a), (5, b), (5, b), (7, "a third text of other words"), (8, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    digest = {r["text"]: bytes(r["digest"]) for r in near_dedup.digested(docs.where("doc_id = 5")).collect()}
    for parts in (1, 4):
        out = P.drop_near_duplicates(spark, docs.repartition(parts), "")
        assert out.columns == docs.columns
        got = [(r["doc_id"], r["text"]) for r in out.collect()]
        assert sorted(str(t) for i, t in got if i is None) == sorted(str(t) for i, t in rows if i is None)
        assert sorted(i for i, _ in got if i is not None) == [5, 7, 8]
        assert dict(got)[5] == min((a, b), key=digest.get)
