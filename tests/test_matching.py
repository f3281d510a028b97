"""Order-dependent matching against plain loops; streams against batch; sources and sinks."""

import random

import pytest
from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import grade, judge, matching, ordered
from linefold.sources import sinks


def random_sets(rnd, n):
    return [frozenset(rnd.sample(range(14), rnd.randrange(0, 9))) for _ in range(n)]


def best_by_trying(refs, exts, least):
    """The greatest summed similarity of any order-preserving pairing."""
    if not refs or not exts:
        return 0.0
    best = max(best_by_trying(refs[1:], exts, least), best_by_trying(refs, exts[1:], least))
    s = matching.jaccard(refs[0], exts[0])
    return max(best, s + best_by_trying(refs[1:], exts[1:], least)) if s >= least else best


def test_align_is_optimal_and_ordered():
    rnd = random.Random(1)
    for _ in range(60):
        refs, exts = random_sets(rnd, rnd.randrange(6)), random_sets(rnd, rnd.randrange(6))
        pairs = matching.align(refs, exts)
        assert all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))
        assert all(s == matching.jaccard(refs[i], exts[j]) >= matching.MIN_SIM for i, j, s in pairs)
        assert sum(p[2] for p in pairs) == pytest.approx(best_by_trying(refs, exts, matching.MIN_SIM))


def test_rescue_keeps_pairs_unique():
    rnd = random.Random(2)
    for _ in range(100):
        refs, exts = random_sets(rnd, 7), random_sets(rnd, 7)
        got = matching.rescue(matching.align(refs, exts), refs, exts)
        assert len({p[0] for p in got}) == len(got) == len({p[1] for p in got})
        free_r, free_e = set(range(7)) - {p[0] for p in got}, set(range(7)) - {p[1] for p in got}
        assert not any(matching.jaccard(refs[i], exts[j]) >= matching.RESCUE_SIM for i in free_r for j in free_e)


def test_rescue_by_place_and_containment():
    s = lambda a, b: frozenset(range(a, b))
    refs, exts = [s(0, 10), s(20, 30), s(40, 50)], [s(0, 10), s(20, 26) | s(60, 62), s(40, 50)]
    assert matching.rescue(matching.align(refs, exts), refs, exts)[1][3] in ("order", "similar", "place")
    assert matching.rescue([], [s(0, 60)], [s(0, 12)]) == [(0, 0, 12 / 60, "contained")]


def test_aligned_per_tag(spark):
    g = lambda t: [t[i : i + 3] for i in range(len(t) - 2)]
    refs = spark.createDataFrame([("a", 0, g("abcdefgh")), ("a", 1, g("mnopqrst")), ("b", 0, g("zzyyxxww"))], "tag string, idx long, grams array<string>")
    exts = spark.createDataFrame([("a", 5, g("mnopqrsx")), ("a", 3, g("abcdefgh")), ("c", 0, g("abcdefgh"))], "tag string, idx long, grams array<string>")
    got = {(r["tag"], r["ref_idx"], r["ext_idx"]) for r in matching.aligned(refs, exts, "tag").collect()}
    assert got == {("a", 0, 3), ("a", 1, 5)}


def longest_chain(numbers, most):
    best = [(0.0, [])]
    for p, (n, shown) in enumerate(numbers):
        for score, path in list(best):
            if not path or 0 < n - numbers[path[-1]][0] <= most:
                best.append((score + 1 + 0.5 * (n == shown), [*path, p]))
    return max(s for s, _ in best)


def test_chain_is_best():
    rnd = random.Random(3)
    for _ in range(80):
        numbers = [(rnd.randrange(1, 9), rnd.randrange(1, 9)) for _ in range(rnd.randrange(1, 9))]
        path = matching.chain(numbers)
        assert all(0 < numbers[b][0] - numbers[a][0] <= 3 and a < b for a, b in zip(path, path[1:]))
        assert sum(1 + 0.5 * (n == s) for n, s in (numbers[p] for p in path)) == longest_chain(numbers, 3)


def test_repaired_numbers(spark):
    rows = [("f", 1, "문제", "1"), ("f", 2, "문제", "25"), ("f", 3, "문제", "10"), ("f", 4, "물음", "?"), ("f", 5, "예제", "12"), ("f", 6, "표", None)]
    df = spark.createDataFrame(rows, "file string, idx long, name string, raw string")
    got = {r["idx"]: (r["num"], r["num_fixed"]) for r in matching.repaired(df, "file", heir="문제").collect()}
    assert got == {1: (1, False), 2: (2, True), 3: (10, False), 4: (11, True), 5: (12, False), 6: (None, False)}


def test_blobs_and_first_kept_and_spaced(spark):
    cells = spark.createDataFrame([(1, 0, 0), (1, 1, 1), (1, 3, 3), (2, 5, 5)], "page long, cx long, cy long")
    assert sorted((r["page"], r["cells"], r["x1"]) for r in matching.blobs(cells, "page").collect()) == [(1, 1, 3), (1, 2, 1), (2, 1, 5)]
    df = spark.createDataFrame([(1, 0, list("abcdef")), (1, 1, list("abcde")), (1, 2, list("xyz")), (1, 3, [])], "g long, idx long, grams array<string>")
    assert [r["kept"] for r in matching.first_kept(df, "g").orderBy("idx").collect()] == [True, False, True, True]
    at = spark.createDataFrame([(1, i) for i in (0, 1, 3, 4, 6, 20)], "g long, idx long")
    assert sorted(r["idx"] for r in matching.spaced(at, "g", "true", 2).collect()) == [0, 3, 6, 20]


def test_overlap_and_skeleton(spark):
    assert matching.matched_share("가나다라", "가나라") == (0.75, 1.0)
    t = spark.createDataFrame([("![](x) 값을 $x^2$ 구하시오 \\frac",)], "t string")
    assert t.select(grade.skeleton(F.col("t"))).first()[0] == "값을구하라"


def test_text_rules(spark):
    one = spark.createDataFrame([("　 x ", 4, 1), ("", 3, 2), (None, 2, 3), ("abcd", 1, 4)], "t string, v int, o int")
    assert [r[0] for r in one.orderBy("o").select(X.first_text("t")).collect()] == ["x", "", "", "abcd"]
    assert one.agg(X.upper_median("v")).first()[0] == 3
    assert [r[0] for r in one.orderBy("o").select(F.array_join(X.grams("t"), "|")).collect()] == ["　 x|" + " x ", "", "", "abc|bcd"]


def test_grams_count_characters(spark):
    texts = ["a😀b😀a", "x" * 50, "가나다라\n마", "ab", "😀😀😀", "abcabcab"]
    got = [sorted(r[0]) for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(X.grams("t")).collect()]
    assert got == [sorted({t[k : k + 3] for k in range(max(1, len(t) - 2))}) for t in texts]


def test_asof_is_the_latest_before(spark):
    rnd = random.Random(4)
    left = [(rnd.randrange(3), i, rnd.randrange(20)) for i in range(60)]
    right = [(rnd.randrange(3), rnd.randrange(20), f"v{i}") for i in range(40)]
    l = spark.createDataFrame(left, "g int, id int, at int")  # noqa: E741
    r = spark.createDataFrame(right, "g int, at int, v string")
    for strict in (False, True):
        got = {x["id"]: x["v"] for x in ordered.asof(l, r, ["g"], "at", "at", "v", strict).collect()}
        for g, i, at in left:
            ok = [(a, v) for h, a, v in right if h == g and (a < at or (a == at and not strict))]
            assert got[i] == (max(ok)[1] if ok else None)


def test_judge_statuses_and_answers(spark):
    df = spark.createDataFrame([(1, "yes"), (2, "no"), (3, "boom"), (4, "skip")], "id long, t string")

    def decide(t):
        if t == "boom":
            raise RuntimeError
        return t == "yes"

    got = {r["id"]: r["status"] for r in judge.judged(df, "t", decide, F.col("id") < 4).collect()}
    assert got == {1: "accepted", 2: "rejected", 3: "failed", 4: "not asked"}
    a = spark.createDataFrame([(1, '```json\n[{"page": 2, "text": "a \\alpha"}]\n```'), (2, "nothing"), (3, "[]")], "id long, answer string")
    assert [tuple(r) for r in judge.answers(a, "answer").collect()] == [(1, 2, "a \\alpha")]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "h")
    df = spark.createDataFrame([("a", 1, 0.5), ("a", 2, 0.7), ("b", 1, 0.1)], "tag string, ord long, score double")
    sinks.append_history(df.where("ord = 1"), path)
    sinks.append_history(df.where("ord = 2"), path)
    (tmp_path / "h" / "x.json").write_text("not json\n")
    got = sorted((r["tag"], r["ord"], r["score"]) for r in sinks.last_of_tag(spark, path, "tag string, ord long, score double", "tag", "ord").collect())
    assert got == [("a", 2, 0.7), ("b", 1, 0.1)]
    sinks.write_csv(df, str(tmp_path / "c"))
    head = next((tmp_path / "c").glob("part-*.csv")).read_bytes()
    assert head.startswith(b"\xef\xbb\xbf")


def test_stream_resumes_from_its_checkpoint(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "event_id long"

    def go():
        q = spark.readStream.schema(schema).parquet(src).writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out)
        q.awaitTermination()
        return sorted(r[0] for r in spark.read.schema(schema).parquet(out).collect())

    spark.range(3).toDF("event_id").write.parquet(src)
    assert go() == [0, 1, 2] == go()
    spark.range(3, 5).toDF("event_id").write.mode("append").parquet(src)
    assert go() == [0, 1, 2, 3, 4]
