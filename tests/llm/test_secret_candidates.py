"""Threshold, candidates and windows of the secret network, and the memory that its training takes."""

import tracemalloc

import numpy as np

from linefold.llm import secret_scan as S


def net(threshold=0.5):
    r = np.random.default_rng(4)
    x = lambda *shape: r.normal(0, 0.4, shape).astype(np.float32)
    return S.Net(x(S.CODES, S.EMBED), x(S.KERNEL * S.EMBED, S.FILTERS), x(S.FILTERS), x(2 * S.FILTERS), 0.1, threshold=threshold)


def test_short_digitless_and_dotted_runs_are_candidates():
    text = "a qWeRtYu. b Xk9z-1 c eyJh.bGci.OiJI d ...... tiny"
    assert [text[s:e] for s, e in S.candidates(text, digits=False)] == ["qWeRtYu", "Xk9z-1", "eyJh.bGci.OiJI"]


def test_scanning_scores_as_single_windows_do():
    rnd = np.random.default_rng(6)
    texts = ["", "é word " + "".join(map(chr, rnd.integers(48, 123, 20_000))), "x" * 500, "short secret\nKEY", "....", "abcdef"]
    texts.append("".join(map(chr, rnd.choice([32, 46, 65, 97, 49, 0x416], 3000))))
    codes, _ = S.joined_codes(texts)
    s, e, run = S.windows_of(*S.runs_of(codes))
    got = S.score_windows(net(), codes, s, e)
    assert len(s) > 300 and np.allclose(got, S.score(net(), S.cut_windows(codes, s, e).astype(np.int64)), atol=1e-5)
    assert (np.diff(np.unique(run)) == 1).all()


def test_the_middle_of_a_long_run_counts():
    n = net()
    n.embed[:], n.filters[:], n.bias[:], n.out[:] = 0, 0, 0, 0
    n.embed[S._code("Z"), 0], n.filters[:, 0], n.out[0], n.out_bias = 1, 1, 10, -5
    text = "see " + "q" * 100 + "ZZZZZ" + "q" * 100 + " and " + "q" * 200
    assert S.find(n, [text])[0][1] == [(4, 209, "net")]


def test_threshold_keeps_the_recall_without_a_floor():
    rnd = np.random.default_rng(9)
    text = lambda own: "".join(map(chr, rnd.integers(*((97, 117) if own else (103, 123)), 12)))
    y = np.arange(1500) % 3 == 0
    codes = np.array([S.encode(f"the {text(k)} word", 4, 16) for k in y])
    order = rnd.permutation(len(y))
    got = S.train(codes[order], y[order].astype(np.int64))
    val = order[::5]
    p = S.score(got, codes[val])
    assert got.threshold < 0.9 and (p[y[val]] >= got.threshold).mean() >= S.RECALL


def test_training_on_a_full_sample_takes_little_of_the_drivers_memory(monkeypatch):
    monkeypatch.setattr(S, "EPOCHS", 1)
    y = np.arange(6 * S.MAX_TRAIN_RUNS) % 3 == 0
    codes = np.random.default_rng(2).integers(1, S.PAD, (len(y), S.WIDTH)).astype(np.uint8)
    codes[y, 30:40] = S._code("Z")
    tracemalloc.start()
    try:
        got = S.train(codes, y.astype(np.int64))
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.recall > 0.9 and most < 100e6
