"""The network finds secrets that no fixed pattern defines, and leaves other long runs alone."""

import random

import pytest

from linefold.llm import secret_scan as S


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")


@pytest.fixture(scope="module")
def net(docs):
    return S.fit(docs)


def test_held_out_findings(net):
    assert net.recall >= 0.9 and net.precision >= 0.9


def test_unseen_secrets_are_added_and_base_findings_stay(net, docs):
    rnd = random.Random(12)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    texts = [r["text"] or "" for r in docs.orderBy("doc_id").limit(400).collect()]
    found, total = 0, 0
    for t in texts:
        at = t.find(" ", len(t) // 2)
        if at < 0:
            continue
        secret = "".join(rnd.choice(letters) for _ in range(rnd.randrange(24, 41)))
        with_it = f"{t[:at]} {secret} {t[at:]}"
        base, every = S.find(net, [with_it])[0]
        total += 1
        found += (at + 1, at + 1 + len(secret), "net") in every
        assert [s for s in every if s[2] != "net"] == base == S.base_spans(with_it)
    assert total > 300 and found >= 0.9 * total


def test_clean_texts_stay(net, docs):
    rows = docs.where("text is not null and length(text) < 20000").orderBy("doc_id").limit(2000).collect()
    added = sum(any(k == "net" for *_, k in every) for _, every in S.find(net, [r["text"] for r in rows]))
    assert added <= 0.01 * len(rows)


def test_added_spans_are_those_of_single_windows(net):
    """Brute force: each candidate is scored window by window on its own."""
    text = "see Zk3Qp9LmX2vB7nR4tY8wC1dF6gH0jS5a now, token=Abcdef123456 and plainword or 4111111111111111 " + "q7Rt" * 40
    want = []
    for a, b in S.candidates(text, digits=False):
        if any(x < b and a < y for x, y, _ in S.base_spans(text)):
            continue
        starts = [*range(a, max(a + 1, b - S.INSIDE + 1), S.STRIDE), max(a, b - S.INSIDE)]
        p = [S.score(net, S.np.array([S.encode(text, s, min(b, s + S.INSIDE))]))[0] for s in starts]
        if max(p) >= net.threshold:
            want.append((a, b, "net"))
    assert want and [s for s in S.find(net, [text])[0][1] if s[2] == "net"] == want
    scored = S.find_scored(net, [text])[0]
    assert all(p is not None and 0 <= p <= 1 for *_, p in scored)
