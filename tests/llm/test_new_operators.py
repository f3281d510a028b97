"""Operators 11 to 13: against SQL, against loops, and on awkward rows."""

import glob
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from linefold.llm import hard_negatives, quality_rules, queries, source_divergence
from tests.test_queries import plain

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_source_divergence", "op12_quality_rules", "op13_hard_negatives"])
def test_whole_tables_against_duckdb(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert plain(df.select(*cols).collect()) == plain(want)


def saved(spark, tmp_path, rows, schema, name):
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# ---- source divergence

DOCS = "doc_id long, text string, lang string, source string, terms string, vector string, value long, p long"


def documents(rows):
    return [(i, *r, "x", "y", 1, 2) for i, r in enumerate(rows)]


def divergence(rows, least, top):
    """The contract as loops over dictionaries."""
    import re

    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in set(d[2]))
        kept = [t for t in df if df[t] >= least]
        groups = {s: Counter() for _, s, _ in own}
        for _, s, terms in own:
            groups[s].update(t for t in terms if df[t] >= least)
        every = sum(groups.values(), Counter())

        def p(c, t):
            return 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s, c in groups.items():
            pair = [(sum(f(p(c, t), p(c2, t)) for t in kept), s2) for s2, c2 in groups.items() if s2 != s]
            term = [(f(p(c, t), p(every, t)), t) for t in kept if c[t] and p(c, t) > p(every, t)]
            for part, found in (("pair", pair), ("term", term)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(found) if part == "pair" or k < top]
    return sorted(out)


def awkward_texts():
    rnd = random.Random(3)
    names = ["alpha", "Beta", "GAMMA", "été", "naïve", "字", "z1z", "the", "of"]
    rows = [(" ".join(rnd.choice(names) for _ in range(rnd.randrange(30))), rnd.choice(["en", "fr", None, ""]), rnd.choice(["a", "b", None, "hot", "hot", "hot"])) for _ in range(120)]
    rows += [(None, "xx", "only"), ("", "xx", None), ("12 34", "yy", "a"), ("one\x00two", "yy", "b"), ("word " * 50_000, "en", "long"), *[("same text here", "en", "hot")] * 40, ("x" * 200_000, "e\x00n", "q")]
    return rows


@pytest.mark.parametrize("most", [2_000_000, 5])
def test_divergence_by_loops(spark, monkeypatch, most):
    """Awkward texts, langs and sources; with a small bound, terms in several blocks, and sums handed on early."""
    if most == 5:
        monkeypatch.setattr(source_divergence, "PROBE", 1)
        monkeypatch.setattr(source_divergence, "MOST_SUMS", 3)
        monkeypatch.setattr(source_divergence, "CELLS", 7)
    rows = awkward_texts()
    docs = spark.createDataFrame(documents(rows), DOCS).repartition(4)
    got = source_divergence.audit(docs, least_docs=3, top_terms=4, most_terms=most)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == divergence(rows, 3, 4)


def test_vectors_are_those_of_the_fitted_model(spark):
    """Texts of one language against ``transform`` of the model, terms split by a regular expression."""
    import re

    import pyarrow as pa
    from pyspark.ml.feature import CountVectorizer

    texts = [(r[0] or "") for r in awkward_texts()]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)) for t in texts]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(terms)], "i int, terms array<string>")
    model = CountVectorizer(inputCol="terms", outputCol="v", minDF=3.0, vocabSize=2**31 - 1).fit(df)
    want = [(r["i"], int(k), int(v)) for r in model.transform(df).orderBy("i").collect() for k, v in zip(r["v"].indices, r["v"].values)]
    kept = pa.array([t.encode() for t in model.vocabulary], pa.binary())
    got = source_divergence.vectors(pa.array([t.encode() for t in texts], pa.binary()), kept, np.arange(len(kept), dtype=np.int32))
    assert list(zip(*(x.tolist() for x in got))) == want


def test_divergence_without_terms(spark):
    none = spark.createDataFrame([], DOCS)
    assert source_divergence.audit(none).count() == 0
    rows = [("a b", "en", "s"), ("a", "en", "t"), ("...", "de", "s")]
    got = source_divergence.audit(spark.createDataFrame(documents(rows), DOCS)).collect()
    assert sorted(map(tuple, got)) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_shares_of_huge_counts_stay_exact(spark):
    n, total, terms = 9_000_000_000_000, 90_000_000_000_007, 13
    df = spark.createDataFrame([(n, total, terms)], "n long, total long, terms long")
    assert df.select(source_divergence.share("n", "total", "terms")).first()[0] == 1 + 10**9 * (n + 2) // (total + 2 * terms)


# ---- quality rules


def facts(text):
    import re

    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i : i + 8]), []).append(i)
    again = {q for starts in at.values() if len(starts) > 1 for i in starts for q in range(i, i + 8)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(again), failed


def rule_texts():
    rnd = random.Random(8)
    some = ["word%d" % i for i in range(40)]
    out = [None, "", " \n\t\x0b\x0c\r ", "one", "a b c", "x" * 300_000, "# * $ % & | < >", "\n\n", "line\nline\n\nline \n line", "é 😀 ß " * 3, "a b c d e f g h", "a b c d e f g h " * 2, "a " * 200, "word " * 60_000]
    for n in (7, 8, 9, 15, 16, 17, 40, 400):
        base = [rnd.choice(some) for _ in range(n)]
        out += [" ".join(base), "  ".join(base + base), "\n".join(base[: n // 2] + ["gap"] + base), " ".join(base * 3)]
    return out * 2


def test_rules_by_loops(spark, tmp_path):
    texts = rule_texts()
    rows = [(i, t, "en", 1, "w", False) for i, t in enumerate(texts)]
    d = saved(spark, tmp_path, rows, "doc_id long, text string, lang string, n_words int, word_chars string, kept boolean", "documents")
    got = {r[0]: tuple(r[1:]) for r in queries.op12_quality_rules(spark, d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i][:6] == facts(t), repr(t)[:80]
        assert not (got[i][5] and got[i][6])
    assert got[texts.index("word " * 60_000)][6] is False


def test_rules_on_an_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, failed_rule string")
    assert quality_rules.screen(none).count() == 0


def test_order_is_by_rejections_per_cost():
    rules = [quality_rules.Rule(n, None) for n in "abc"]
    # a rejects most but costs ten times as much; what c rejects, b rejects too
    known = quality_rules.Profile({"a": 10.0, "b": 1.0, "c": 1.0}, {(True, True, False): 20, (True, True, True): 10, (True, False, False): 30, (False, False, False): 40})
    assert [r.name for r in quality_rules.ordered(rules, known)] == ["b", "a", "c"]


def test_verdict_does_not_depend_on_the_order_and_later_rules_are_not_asked(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rule_texts())], "doc_id long, text string")
    rules, m = [*quality_rules.BASE, *quality_rules.FURTHER], quality_rules.Measures("text")
    one, two = (quality_rules.cascade(docs, order, m).select("doc_id", "kept").collect() for order in (rules, rules[::-1]))
    assert sorted(one) == sorted(two)
    bomb = quality_rules.Rule("bomb", lambda _: F.raise_error("asked").isNotNull())
    first = quality_rules.Rule("all", lambda _: F.col("doc_id") >= 0)
    assert quality_rules.cascade(docs, [first, bomb], m).where("failed_rule != 'all'").count() == 0


def test_clean_prose_is_kept_and_junk_is_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = quality_rules.screen(docs).join(labels, "doc_id").where("size(split(trim(text), ' ')) >= 25").groupBy("quality").agg(F.avg(F.col("kept").cast("int"))).collect()
    share = dict(map(tuple, kept))
    assert share[1] > 0.97 and share[0] < 0.5


def test_the_plan_has_no_python(spark):
    plan = queries.op12_quality_rules(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


# ---- hard negatives


def negatives(rows):
    seen = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = [int(np.floor(float(np.float32(x)) * 256)) for x in e]
        item = ((label + 1) % 10 if i % 7 == 0 else label, v)
        seen[i] = min(seen.get(i, item), item)

    def dot(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for a, (la, va) in seen.items():
        if a % 50:
            continue
        score = {b: dot(va, vb) for b, (_, vb) in seen.items() if b != a}
        near = sorted((b for b in score if seen[b][0] == la), key=lambda b: (-score[b], b))[:5]
        for p in near:
            mine = sorted((b for b in score if seen[b][0] != la and 50 * score[p] <= 100 * score[b] <= 95 * score[p]), key=lambda b: (-score[b], b))[:3]
            out += [(a, p, k + 1, b, score[p], score[b]) for k, b in enumerate(mine)]
    return sorted(out)


EMB = "vec_id long, embedding array<float>, label int, v string, batch int, block int, rank int"


def vectors(seed=1, n=400, dims=12):
    rnd = np.random.default_rng(seed)
    rows = [(i, rnd.normal(0, 0.2, dims).astype("float32").tolist(), int(rnd.integers(0, 10))) for i in range(n)]
    rows += [(1000 + i, rows[0][1], i % 10) for i in range(150)]  # a third of all rows is one vector, anchor 0's
    rows += [(2000, None, 1), (2050, rows[1][1], None), (None, rows[1][1], 1), (2100, [0.1, None], 1), (2150, [float("nan")] * dims, 1), (2200, [float("inf")] * dims, 2)]
    rows += [(2250, rows[2][1][:5], 3), (2251, [], 3), (2300, [0.0] * dims, 4), (50, rows[3][1], 0), (50, rows[50][1], rows[50][2]), (7, rows[7][1], rows[7][2])]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_negatives_by_loops(spark, tmp_path, seed):
    rows = vectors(seed)
    d = saved(spark, tmp_path, [(*r, "v", 1, 2, 3) for r in rows], EMB, "embeddings")
    got = queries.op13_hard_negatives(spark, d).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()
    assert sorted(map(tuple, got)) == negatives(rows)


def test_negatives_in_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 40)
    monkeypatch.setattr(hard_negatives, "BATCH", 3)
    rows = vectors(5)
    df = spark.createDataFrame([(*r, "v", 1, 2, 3) for r in rows], EMB)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    assert sorted(map(tuple, hard_negatives.mine(df, label, F.col("vec_id") % 50 == 0).collect())) == negatives(rows)


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], EMB)
    assert hard_negatives.mine(none, F.col("label"), F.col("vec_id") % 50 == 0).count() == 0


def test_bounds_shrink_the_candidates():
    """The scan leaves exactly the rows that full products leave, and reads the columns of fewer and fewer rows."""
    rnd = np.random.default_rng(0)
    cols = rnd.integers(-50, 50, (64, 3000))
    a = np.sort(rnd.integers(-20, 20, 64)) ** 3
    seen = []

    def cut(low, high):
        seen.append(len(low))
        return hard_negatives.nearest(5)(low, high)

    rows, score = hard_negatives.scan(cols, cols.min(1), cols.max(1), a, np.arange(3000), cut)
    whole = a @ cols
    assert (score == whole[rows]).all() and set(np.argsort(-whole)[:5]) <= set(rows)
    assert seen == sorted(seen, reverse=True) and seen[-2] < 1500


def test_held_out_is_never_null(spark):
    from linefold.llm.common import held_out

    got = spark.createDataFrame([(None,), (1,), (3,)], "doc_id long").select("doc_id", held_out().alias("h")).collect()
    assert all(r["h"] is not None for r in got) and [r["h"] for r in got if r["doc_id"] is None] == [False]
