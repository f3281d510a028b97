"""The filter returns all languages of each n-gram."""

import numpy as np

from linefold.llm import language_id as L


def test_every_ngram_of_every_language_is_found(spark):
    shared, own = "common words that all of them use every day", {"aa": "zebra quilt", "bb": "fjord oxide", "cc": "mango vivid", "dd": "pixel gnome"}
    rows = [(i, lang, f"{shared} {text}" + (" onlyonce" if i < 4 else "")) for i, (lang, text) in enumerate(list(own.items()) * 150)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = L.fit(docs)
    train = docs.where(~L.held_out()).collect()
    for i, lang in enumerate(model.langs):
        h, _, _ = L.ngrams([r["text"] for r in train if r["lang"] == lang])
        at = L._slots(np.unique(h), model.bits)
        assert ((model.slots[0][at[0]] & model.slots[0][at[1]] & model.slots[0][at[2]]) >> np.uint64(i) & np.uint64(1)).all()
    assert L.predict(model, ["common words"])[1][0] > 0
    assert L.predict(model, [f"every day {t}" for t in own.values()])[0] == list(own)


def test_slots_grow_with_the_ngrams(spark, monkeypatch):
    monkeypatch.setattr(L, "ROOM", 1 << 14)
    docs = spark.createDataFrame([(i, "aa", f"word{chr(97 + i)} other") for i in range(20)], "doc_id long, lang string, text string")
    model = L.fit(docs)
    assert model.bits > L.SLOT_BITS and model.slots.shape[1] == 1 << model.bits
    assert L.predict(model, ["other"]) == (["aa"], [1.0])
