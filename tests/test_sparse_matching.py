"""Set joins in blocks, alignment over sparse pairs and keep-first in rounds, against loops over everything."""

import random

import pytest

from linefold.functions.text import grams
from linefold.operators import matching, similarity


def dense(refs, exts, least=matching.MIN_SIM):
    """The full table of sums: up before left, a pair only if strictly more."""
    best = [[0.0] * (len(exts) + 1)]
    step = []
    for r in refs:
        row, moves = [0.0], [""]
        above = best[-1]
        for j, e in enumerate(exts):
            value, move = (above[j + 1], "up") if above[j + 1] >= row[j] else (row[j], "left")
            s = matching.jaccard(r, e)
            if s >= least and above[j] + s > value:
                value, move = above[j] + s, "pair"
            row.append(value)
            moves.append(move)
        best.append(row)
        step.append(moves)
    out, i, j = [], len(refs), len(exts)
    while i and j:
        move = step[i - 1][j]
        if move == "pair":
            out.append((i - 1, j - 1, matching.jaccard(refs[i - 1], exts[j - 1])))
        i, j = i - (move != "left"), j - (move != "up")
    return out[::-1]


def rescue_of_all(pairs, refs, exts):
    """The three rescues, each over all free refs and exts."""
    out = [(*p, "order") for p in pairs]
    free_r = set(range(len(refs))) - {p[0] for p in pairs}
    free_e = set(range(len(exts))) - {p[1] for p in pairs}

    def take(i, j, s, how):
        free_r.discard(i)
        free_e.discard(j)
        out.append((i, j, s, how))

    def greedy(scored, how):
        for *_, sim, i, j in sorted(scored, reverse=True):
            if i in free_r and j in free_e:
                take(i, j, sim, how)

    greedy([(s, i, j) for i in free_r for j in free_e if (s := matching.jaccard(refs[i], exts[j])) >= matching.RESCUE_SIM], "similar")
    for j in sorted(free_e):
        low = max((i for i, e, *_ in out if e < j), default=-1)
        high = min((i for i, e, *_ in out if e > j), default=len(refs))
        sim, i = max(((matching.jaccard(refs[i], exts[j]), -i) for i in range(low + 1, high) if i in free_r), default=(0.0, 0))
        if sim >= matching.RESCUE_ORDER_SIM:
            take(-i, j, sim, "place")
    inside = []
    for i in free_r:
        for j in free_e:
            both = len(refs[i] & exts[j])
            if both >= matching.CONTAIN_LEAST and both >= matching.CONTAIN_SIM * min(len(refs[i]), len(exts[j])):
                inside.append((both / min(len(refs[i]), len(exts[j])), matching.jaccard(refs[i], exts[j]), i, j))
    greedy(inside, "contained")
    return sorted(out)


def random_sets(rnd, n, of=14, most=9):
    return [frozenset(rnd.sample(range(of), rnd.randrange(0, most))) for _ in range(n)]


def test_sparse_alignment_is_the_dense_one():
    rnd = random.Random(7)
    for k in range(400):
        of, most = rnd.choice([(3, 3), (6, 5), (14, 9), (30, 25)])  # few elements make many ties
        refs, exts = random_sets(rnd, rnd.randrange(12), of, most), random_sets(rnd, rnd.randrange(12), of, most)
        want = dense(refs, exts)
        assert matching.align(refs, exts) == want, k
        assert matching.rescue(want, refs, exts) == rescue_of_all(want, refs, exts), k


def test_aligned_groups_of_all_sizes(spark, monkeypatch):
    """Tags with nothing, few and many rows; a large tag is cut into blocks."""
    monkeypatch.setattr(similarity, "BATCH", 7)
    monkeypatch.setattr(similarity, "BLOCK", 5)
    rnd = random.Random(11)
    groups = {t: (random_sets(rnd, n, 30, 25), random_sets(rnd, m, 30, 25)) for t, (n, m) in {"a": (0, 3), "b": (4, 0), "c": (1, 1), "d": (9, 12), "hot": (60, 50)}.items()}
    rows = lambda side: [(t, i, [f"g{x}" for x in s]) for t, g in groups.items() for i, s in enumerate(g[side])]
    schema = "tag string, idx long, grams array<string>"
    got = matching.aligned(spark.createDataFrame(rows(0), schema), spark.createDataFrame(rows(1), schema), "tag").collect()
    want = [(t, *p) for t, (r, e) in groups.items() for p in rescue_of_all(dense(r, e), r, e)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_many_small_tags_are_no_calls_of_their_own(spark, monkeypatch):
    """Tags are dealt into bins by their rows, and a choice is one pass over sorted pairs; texts give the same as their trigrams."""
    monkeypatch.setattr(similarity, "BIN", 10)
    rows = spark.range(120).selectExpr("id div 4 as t", "id % 4 as idx", "concat('some text of its own ', cast(id div 8 as string), repeat(cast(id % 3 as string), 9)) as text")
    sides = lambda r: (r.where("idx % 2 = 0"), r.where("idx % 2 = 1"))
    got = matching.aligned(*sides(rows), "t")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroupsInPandas" not in plan
    want = matching.aligned(*sides(rows.select("t", "idx", grams("text").alias("grams"))), "t")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


@pytest.mark.parametrize("on", [None, ["g"]])
def test_set_join_against_all_pairs(spark, monkeypatch, on):
    monkeypatch.setattr(similarity, "BATCH", 9)
    monkeypatch.setattr(similarity, "BLOCK", 8)
    monkeypatch.setattr(similarity, "CELLS", 30)
    rnd = random.Random(3)
    sizes = [0, 1, 2, 3, 5, 8, 17, 40, 120]
    make = lambda n, seed: [(rnd.choice([None, "x", "hot", "hot", "hot"]), i, [int(v) for v in rnd.sample(range(130), rnd.choice(sizes))]) for i in range(n)]
    left, right = make(50, 1), make(70, 2)
    frame = lambda rows, name: spark.createDataFrame([(*r, len(r[2])) for r in rows], f"g string, {name} long, grams array<long>, size long")
    for keep in (lambda n, a, b: n / (a + b - n) >= 0.35, lambda n, a, b: (n >= 10) & ((n >= 0.6 * a) | (n >= 0.6 * b)), lambda n, a, b: n * 100 >= 55 * a):
        got = similarity.overlaps(frame(left, "i"), frame(right, "j"), ["g", "i"] if on else ["i"], ["g", "j"] if on else ["j"], on=on, keep=keep).collect()
        want = []
        for g, i, a in left:
            for h, j, b in right:
                n = len(set(a) & set(b))
                if n and (not on or g == h) and keep(n, len(a), len(b)):
                    want.append((i, j, n, len(a), len(b)))
        assert sorted((r["i"], r["j"], r["inter"], r["left_size"], r["right_size"]) for r in got) == sorted(want)


def test_set_join_of_nothing(spark):
    none = spark.createDataFrame([], "i long, grams array<long>, size long")
    assert similarity.overlaps(none, none.withColumnRenamed("i", "j"), ["i"], ["j"]).count() == 0


def trigrams(t):
    return {t[i : i + 3] for i in range(max(len(t) - 2, 1))} if t else set()


@pytest.mark.parametrize("wide", [False, True])
def test_set_join_of_texts(spark, monkeypatch, wide):
    """Texts as they are: short ones, NULs, characters beyond the basic plane, and an alphabet too large for packed numbers."""
    monkeypatch.setattr(similarity, "BATCH", 9)
    monkeypatch.setattr(similarity, "BLOCK_GRAMS", 300)
    monkeypatch.setattr(similarity, "STEP_GRAMS", 50)
    monkeypatch.setattr(similarity, "CELLS", 30)
    rnd = random.Random(5)
    letters = "ab\0é가😀" + ("".join(map(chr, range(0x4E00, 0x4E00 + 9000))) if wide else "")
    make = lambda n, own: [(i, "".join(rnd.choice(letters[:4] if rnd.random() < 0.8 else letters) for _ in range(rnd.choice([0, 1, 2, 3, 4, 9, 30, 80])))) for i in range(n)] + [(n, None), (n + 1, own)]
    left, right = make(30, letters), make(60, letters[::-1] + letters)
    for keep in (lambda n, a, b: n / (a + b - n) >= 0.35, lambda n, a, b: (n >= 10) & ((n >= 0.6 * a) | (n >= 0.6 * b)), lambda n, a, b: n * 100 >= 55 * a):
        got = similarity.overlaps(spark.createDataFrame(left, "i long, text string"), spark.createDataFrame(right, "j long, text string"), ["i"], ["j"], keep=keep, most=lambda: 40_000).collect()
        sets = [(i, trigrams(t), j, trigrams(u)) for i, t in left for j, u in right]
        want = [(i, j, n, len(a), len(b)) for i, a, j, b in sets if (n := len(a & b)) and keep(n, len(a), len(b))]
        assert sorted((r["i"], r["j"], r["inter"], r["left_size"], r["right_size"]) for r in got) == sorted(want)


def test_a_right_row_is_dealt_once(spark):
    """Whatever sizes can be similar enough, a right row goes to one block of a batch; blocks follow the input."""
    keep = lambda n, a, b: (n >= 10) & ((n >= 0.6 * a) | (n >= 0.6 * b))
    right = spark.range(500).selectExpr("id as j", "repeat(cast(id as string), 5) as text")
    a, b = similarity._in_blocks(spark.range(3).selectExpr("id as i", "'abcabc' as text"), right, ["i"], ["j"], lambda: 50 * similarity.BLOCK_GRAMS, 4)
    assert b.count() == 500 and a.count() == 150
    assert similarity.overlaps(a.select("i", "text"), right, ["i"], ["j"], keep=keep).count() == 0


def kept_in_order(sets, least=0.85):
    kept, flags = [], []
    for g in sets:
        ok = not any(g and k and len(g & k) >= least * min(len(g), len(k)) for k in kept)
        flags.append(ok)
        if ok:
            kept.append(g)
    return flags


@pytest.mark.parametrize("rounds", [0, 1, 8])
def test_keep_first_in_rounds(spark, monkeypatch, rounds):
    """Random groups, copies, null and empty sets, and a chain in which each row contains a part of the one before."""
    monkeypatch.setattr(matching, "ROUNDS", rounds)
    monkeypatch.setattr(similarity, "BLOCK", 11)
    monkeypatch.setattr(similarity, "BATCH", 11)
    rnd = random.Random(rounds)
    groups = {g: random_sets(rnd, 40, 8, 7) for g in range(3)}
    groups[3] = [frozenset(range(k, k + 20)) for k in range(0, 90, 3)]  # neighbours alike, others less: every second one goes
    groups[None] = random_sets(rnd, 30, 9, 9) + [groups[0][0]] * 3
    rows = [(g, i, [f"x{v}" for v in s]) for g, sets in groups.items() for i, s in enumerate(sets)] + [(4, 0, None), (4, 1, None)]
    df = spark.createDataFrame(rows, "g long, idx long, grams array<string>").repartition(3)
    got = {(r["g"], r["idx"]): r["kept"] for r in matching.first_kept(df, "g").collect()}
    want = {(g, i): k for g, sets in groups.items() for i, k in enumerate(kept_in_order(sets))} | {(4, 0): True, (4, 1): True}
    assert got == want
