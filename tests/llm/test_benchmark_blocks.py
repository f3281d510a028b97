"""A benchmark of many blocks gives what one block gives."""

import random

from linefold.llm import decontaminate as D


def test_blocks_beyond_what_a_worker_keeps(spark, monkeypatch):
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rnd.choice([3, 13, 40, 200])))) for i in range(300)]
    docs = []
    for i in range(300):
        t = [word() for _ in range(rnd.randrange(80))]
        for _ in range(rnd.randrange(3)):
            own = rnd.choice(items)[1].split()
            a = rnd.randrange(max(1, len(own) - 13))
            t += own[a : a + rnd.randrange(1, 30)]
        docs.append((i % 250, " ".join(t)))
    docs += [(None, items[0][1]), (None, None), (900, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([*items, items[0], (None, "a b c"), (999, None)], "item_id long, text string")

    def result(blocks):
        return sorted(map(str, D.scan(df, blocks).collect()))

    one = D.blocks_of(bench)
    want = result(one)
    many = D.blocks_of(bench, block_words=500)
    assert len(one) == 1 and len(many) > 20
    monkeypatch.setattr(D, "HELD_WORDS", 2_000)
    assert result(many) == want
    # plain: words in a row
    by = {i: t.split() for i, t in items}
    grams = {tuple(w[k : k + min(13, len(w))]) for w in by.values() for k in range(len(w) - min(13, len(w)) + 1)}
    for r in D.scan(df, many).collect():
        w = (r["text"] or "").split()
        hit = {q for n in {len(g) for g in grams} for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in grams for q in range(k, k + n)}
        assert r["n_hit"] == len(hit)
