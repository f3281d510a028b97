"""The training-data operators: against brute force, and on awkward rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from linefold.llm import bpe, chat_format, decontaminate, language_id, license_scan, media_columns, near_dedup, quality_knn, queries, secret_scan, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, contaminated string, component_id string, digest string"
CLASH = ("s", "c", "k", "d")


def docs_of(spark, rows, parts=3):
    """(doc_id, text[, lang]) rows with extra columns named like the operators' own."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "src", len(r[1] or ""), *CLASH) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


@pytest.fixture(scope="module")
def some(spark, sf):
    """Real documents with copies, edits, nulls, empty and very long texts."""
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    rnd = random.Random(5)
    out = list(rows)
    for i, (_, text, lang) in enumerate(rows[:40]):
        words = text.split(" ")
        for j in range(3):
            w = list(words)
            for _ in range(j * max(1, len(w) // 120)):
                w[rnd.randrange(len(w))] = "edit%d" % rnd.randrange(1000)
            out.append((1000 + 3 * i + j, " ".join(w), lang))
    out += [(2000, None), (2001, ""), (2002, "  \n\t "), (2003, "one"), (2004, "One two"), (2005, "one TWO"), (2006, "... 123 !!"), (2007, "x" * 300_000), (2008, "word " * 60_000), (2009, "é 😀 \x1c 　 ß"), (None, "no id here at all"), (2010, None, "en")]
    return out


@pytest.fixture(scope="module")
def docs(spark, some):
    return docs_of(spark, some).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs_of(spark, [], 1)


@pytest.fixture(scope="module")
def labels(spark, sf):
    return spark.read.parquet(f"{sf}/labels.parquet")


# ---- language identification


def test_language(spark, docs, some, empty):
    model = language_id.fit(docs)
    got = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert all(got[i]["lang_pred"] == "und" for i in (2000, 2001, 2002, 2006, 2010))
    assert got[2003]["lang_pred"] in model.langs and got[2000]["digest"] == "d"
    known = [(r[0], r[2]) for r in some if len(r) > 2 and r[1] and r[0] < 2000]
    assert np.mean([got[i]["lang_pred"] == lang for i, lang in known]) > 0.97
    assert language_id.fit(empty) is None and language_id.identify(empty, model).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}


def test_language_filter_has_no_false_negatives(docs):
    model = language_id.fit(docs)
    rows = docs.where("lang = 'de' and text is not null").where(~language_id.held_out()).select("text").collect()
    h, _, _ = language_id.ngrams([r[0] for r in rows])
    gram, n = np.unique(h, return_counts=True)
    common = gram[np.argsort(-n)[:50]]
    at = language_id._slots(common)
    bit = np.uint64(1 << model.langs.index("de"))
    hits = (model.slots[0][at[0]] & model.slots[0][at[1]] & model.slots[0][at[2]] & bit) > 0
    assert hits.mean() > 0.3


# ---- benchmark decontamination


def plain_hits(text, items, window=13):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())
    hit, found = set(), set()
    for item, body in items:
        own = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (body or "").encode().lower())
        n = min(window, len(own))
        for k in range(len(own) - n + 1 if n else 0):
            for p in range(len(words) - n + 1):
                if words[p : p + n] == own[k : k + n]:
                    hit |= set(range(p, p + n))
                    found.add(item)
    return len(words), len(hit), sorted(map(str, found))


@pytest.mark.parametrize("block_words", [500_000, 30])
def test_decontamination_against_brute_force(spark, block_words):
    rnd = random.Random(1)
    vocab = ["a", "b", "cé", "d9", "E"]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(n))) for i, n in enumerate([3, 13, 20, 30, 1, 0])] + [(9, None), (10, "A b, CÉ")]
    texts = [None, "", "..."] + [" ,".join(rnd.choice(vocab) for _ in range(rnd.randrange(1, 80))) for _ in range(60)]
    texts += [f"q {items[2][1].upper().replace('É', 'é')}! z", items[3][1] + " " + "z " * 700]
    df = docs_of(spark, list(enumerate(texts)))
    bench = spark.createDataFrame(items + items[:2], "item_id long, text string")
    blocks = decontaminate.blocks_of(bench, block_words=block_words)
    got = {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in decontaminate.scan(df, blocks).collect()}
    for i, t in enumerate(texts):
        n, h, found = plain_hits(t, items)
        assert got[i] == (n, h, found, h > 0 and 20 * h >= n)
    clean = decontaminate.clean(df, blocks)
    assert clean.columns == df.columns
    left = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert set(left) == {i for i in got if not got[i][3]} and left[0] is None


def test_decontamination_removes_spans_and_empty_tables(spark, empty):
    item = " ".join(f"w{i}" for i in range(13))
    long = "Début, " + "filler " * 600 + item + "; fin"
    df = docs_of(spark, [(1, long)])
    blocks = decontaminate.blocks_of(spark.createDataFrame([(1, item)], "item_id long, text string"))
    out = decontaminate.clean(df, blocks).first()["text"]
    assert "w0" not in out and out.startswith("Début, filler") and out.endswith("; fin")
    assert decontaminate.scan(empty, blocks).count() == 0 and decontaminate.scan(df, []).first()["n_hit"] == 0


# ---- near duplicates


def plain_components(rows):
    sets = {}
    for i, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")) if x]
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_duplicates_against_brute_force(docs, some):
    got = near_dedup.near_duplicates(docs).collect()
    want = plain_components([(r[0], r[1]) for r in some if r[0] is not None])
    assert len(got) == len(some)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == want
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got if r["doc_id"] is not None)


def test_near_duplicates_family_in_blocks(spark, monkeypatch):
    rnd = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(140):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 4, 6])):
            w[rnd.randrange(120)] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    want = {i: c for i, (_, c) in plain_components(rows).items()}
    df = docs_of(spark, rows)
    for block in (512, 16):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        assert {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(df).collect()} == want


def test_near_duplicates_repeated_ids_and_empty(spark, empty):
    a, b = "one two three four five six", "quite other words are here now"
    df = docs_of(spark, [(5, a), (5, a), (5, b), (7, a), (8, b), (9, None)])
    got = sorted((r["doc_id"], r["component_id"]) for r in near_dedup.near_duplicates(df).collect())
    assert len(got) == 6 and got[:3] == [(5, 5)] * 3 and got[5] == (9, 9)
    assert {got[3][1], got[4][1]} in ({5, 8}, {7, 5})
    assert near_dedup.near_duplicates(empty).count() == 0


def test_sketches_merge_and_estimate():
    rnd = np.random.default_rng(1)
    x, y = rnd.integers(0, 2**64, 4000, np.uint64), rnd.integers(0, 2**64, 1000, np.uint64)
    a, b, both = near_dedup.registers([np.unique(x), np.unique(np.concatenate([x[:3500], y])), np.unique(np.concatenate([x, y]))])
    assert (np.maximum(a, b) == both).all()
    est = near_dedup.likelihood_estimate((a == b).sum(), (a > b).sum(), (a < b).sum(), 4000, 4500)
    assert abs(est - 3500 / 5000) < 0.16


# ---- byte-level BPE


@pytest.fixture(scope="module")
def ranks():
    return bpe.load(queries.VOCABULARY, queries.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks={t: i for i, t in enumerate(ranks.tokens) if t}, special_tokens={})


def test_bpe_equals_library(docs, some, library):
    got = {r["doc_id"]: r for r in bpe.round_trip(docs, queries.VOCABULARY, queries.PATTERN, with_ids=True).collect()}
    for i, t, *_ in some:
        if i != 2007:  # one word of 300,000 letters: the library takes long
            ids = library.encode_ordinary(t or "")
            assert got[i]["ids"] == ids and got[i]["n_tokens"] == len(ids)
            assert got[i]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest() and got[i]["exact"]


def test_bpe_replay_equals_word_by_word(ranks, library):
    rnd = random.Random(4)
    words = ["".join(rnd.choice(" thaeéßn'日") for _ in range(rnd.randrange(1, 30))) for _ in range(2000)] + ["", "a" * 99, " th" * 20]
    got = bpe.replay(ranks, [w.encode() for w in words])
    for w, ids in zip(words, got):
        assert np.frombuffer(ids, "<u4").tolist() == (library._core_bpe.encode_single_piece(w.encode()) if w else [])


def test_bpe_decode_and_empty(spark, docs, empty):
    enc = bpe.encode(docs.where("doc_id is not null"), queries.VOCABULARY, queries.PATTERN)
    assert bpe.decode(enc, queries.VOCABULARY, queries.PATTERN).where("decoded != encode(coalesce(text, ''), 'utf-8')").count() == 0
    assert bpe.round_trip(empty, queries.VOCABULARY, queries.PATTERN).count() == 0


# ---- secrets


def plain_base(text):
    out = []
    for kind, pattern, keep in (
        ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ):
        out += [(m.start(), ["assign", "access", "hex"].index(kind), m.end(), kind) for m in re.finditer(pattern, text or "") if keep(m)]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_secrets_base_and_redaction(spark, docs, some, empty):
    tricky = ["token=abc token: 'abcdef1'", "é API_KEY = \"Zz9+/=\" apikey:12345", "AKIAAKIA" + "X" * 15, "AKIA" + "Q" * 16, "0123456789abcdef01234567 ABCDEF" + "a" * 23, "password : token=secret=abcdef", "", None]
    df = docs.select("doc_id", "text").union(spark.createDataFrame([(3000 + i, t) for i, t in enumerate(tricky)], "doc_id long, text string"))
    net = secret_scan.fit(docs)
    texts = {r[0]: r[1] for r in df.collect()}
    got = {r["doc_id"]: r for r in secret_scan.scan(df, net).collect()}
    for i, t in texts.items():
        spans = got[i]["findings"]
        assert ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans if s["base"]) == plain_base(t)
        assert [s["start"] for s in spans] == sorted(s["start"] for s in spans)
    red = {r["doc_id"]: r["text"] for r in secret_scan.redact(df, net).collect()}
    assert red[3000 + len(tricky) - 1] is None and red[3000].startswith("token=abc [assign]")
    assert all(not plain_base(t) for i, t in red.items() if i is not None and i < 2000)
    assert secret_scan.scan(empty, net).count() == 0 and secret_scan.fit(empty) is None


def test_secret_network_learns_and_generalises():
    rnd = random.Random(8)
    rand = lambda n, s: "".join(rnd.choice(s) for _ in range(n))
    pos = [f'x {rnd.choice(["token", "secret"])} = "{rand(40, "0123456789abcdef")}" y' for _ in range(200)]
    neg = [f"card {rand(16, '0123456789')} next" for _ in range(200)] + [f"the {rand(20, 'abcdefghijklmnop')} word" for _ in range(200)]
    codes = np.array([secret_scan.encode(t, *secret_scan.candidates(t, False)[0]) for t in pos + neg])
    y = np.array([1] * len(pos) + [0] * len(neg))
    order = np.random.default_rng(1).permutation(len(y))
    net = secret_scan.train(codes[order], y[order])
    p = secret_scan.score(net, codes)
    assert (p[y == 1] >= net.threshold).mean() >= 0.95 and (p[y == 0] >= net.threshold).mean() <= 0.02


# ---- toxicity


def test_toxicity(docs, labels, empty):
    grammar = toxicity.fit(docs, labels)
    rows = {r["doc_id"]: r for r in toxicity.detect(docs, grammar).collect()}
    base = rows[2000]["score"]
    assert all(rows[i]["score"] == base for i in (2001, 2002, 2003, 2007)) and 0 <= base < 0.5
    assert toxicity.detect(empty, grammar).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).score("anything") < 0.5


def test_toxicity_grammar():
    g = toxicity.Grammar({"idiot": 4.0, "lowei": 3.0}, (-5.0, 3.0, 0.5))
    plain, targeted = g.clause_score("such an idiot here"), g.clause_score("you such an idiot")
    assert targeted > plain > g.clause_score("not such an idiot") > 0
    assert g.clause_score("someone said an idiot came") < plain
    assert g.clause_score("nice weather today") == 0 and g.clause_score("kill them") > 0
    assert g.clause_score("loweiheit ist") > 0 and g.clause_score("flowei ist") == 0
    assert len(g.clauses("An idiot. Fine. Idiot, idiot!")) == 3 and g.score("you idiot") > 0.5 > g.score("a day")


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    for query, label in ((queries.op2_toxicity, "toxic"), (queries.op4_quality_knn, "quality")):
        got = query(spark, d).where("held_out").join(labels, "doc_id").groupBy(label).agg(F.avg((F.col("predicted") == F.col(label)).cast("int")).alias("r"))
        right = {r[label]: r["r"] for r in got.collect()}
        assert right[0] > 0.95 and right[1] > 0.85, (label, right)
    got = queries.op8_language_id(spark, d).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


# ---- quality


def test_quality(docs, labels, empty):
    space = quality_knn.fit(docs, labels)
    rows = {r["doc_id"]: r["score"] for r in quality_knn.rate(docs, space).collect()}
    assert rows[2000] == rows[2001] == 0.0 and all(0 <= s <= 1 for s in rows.values())
    assert quality_knn.rate(empty, space).count() == 0 and quality_knn.fit(docs, labels.limit(0)) is None


def test_quality_votes_are_exact():
    r = np.random.default_rng(3)
    unit = lambda x: (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    space = quality_knn.Space(None, None, unit(r.normal(size=(3000, 8))), r.integers(0, 2, 3000).astype(np.float32))
    v = unit(r.normal(size=(20, 8)))
    got = quality_knn.vote(space, v)
    for x, s in zip(v, got):
        cos = space.vectors @ x
        top = np.argsort(-cos, kind="stable")[: quality_knn.NEIGHBOURS]
        w = np.maximum(cos[top], 0) ** 4 + 1e-9
        assert abs((w * space.labels[top]).sum() / w.sum() - s) < 1e-4


# ---- licenses


def test_license_scan(spark, docs, empty):
    text = "Intro é. Licensed under the Apache Licence, Version 2.0. Middle. Released under the MIT License. End"
    df = docs_of(spark, [(1, text), (2, None), (3, ""), (4, "Licensed under"), (1, text)])
    got = [r.asDict() for r in license_scan.matches(df).collect()]
    one = [g for g in got if g["doc_id"] == 1]
    assert len(one) == 4 and {g["license"] for g in one} == {"Apache-2.0", "MIT"} and len(got) == 4
    for g in one:
        cut = text[g["start"] : g["end"]]
        assert cut.startswith(("Licensed under", "Released under")) and cut.endswith(("2.0", "License")) and g["coverage"] >= 0.8
    assert license_scan.matches(empty).count() == 0
    full = [t for t in license_scan.TEMPLATES if t[0] == "MIT"][1][1]
    words = full.split()
    del words[10:14]
    hit = license_scan.find(license_scan.Index(license_scan.TEMPLATES), ["x y z " + " ".join(words) + " tail"])[0]
    assert [h["license"] for h in hit] == ["MIT"] and 0.9 < hit[0]["coverage"] < 1


def test_winnowing_keeps_a_common_fingerprint():
    rnd = random.Random(9)
    for _ in range(200):
        run = [f"r{rnd.randrange(50)}" for _ in range(license_scan.GRAM + license_scan.WINNOW - 1)]
        a = [f"a{i}" for i in range(rnd.randrange(6))] + run + [f"b{i}" for i in range(rnd.randrange(6))]
        b = [f"c{i}" for i in range(rnd.randrange(6))] + run + [f"d{i}" for i in range(rnd.randrange(6))]
        assert set(license_scan.fingerprints(a)[1].tolist()) & set(license_scan.fingerprints(b)[1].tolist())


# ---- media


def test_media(docs, some, empty):
    rows = media_columns.store(docs)
    at = media_columns.located(rows)
    found = {r["digest"]: r for r in media_columns.read_back(at).collect()}
    heads = {r["digest"]: r for r in media_columns.header_columns(at).collect()}
    by = {r["doc_id"]: r for r in rows.collect()}
    assert set(by) == {r[0] for r in some} and set(found) == set(heads) == {r["digest"] for r in by.values()}
    for i, t, *_ in some:
        raw = (t or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        f = found[by[i]["digest"]]
        assert (by[i]["n_bytes"], by[i]["payload_bytes"], f["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).digest())
        head = heads[by[i]["digest"]]
        assert f["tail_crc32"] == zlib.crc32(payload[-16:]) and head["width"] == 192 and head["height"] * 192 == len(payload) and head["sample_bits"] == 8
    assert media_columns.read_back(media_columns.header_columns(media_columns.located(media_columns.store(empty)))).count() == 0


# ---- chat


def test_chat(spark):
    rows = [
        (1, 0, "user", "a"), (1, 1, "assistant", "b"),
        (2, 0, "user", "a"), (2, 1, "assistant", "b"), (2, 2, "user", "c"),
        (3, 0, "user", "a"), (3, 1, "assistant", "x"),
        (4, 0, "user", "a"), (4, 1, "assistant", "b"), (4, 2, "user", "c"),
        (5, 0, None, None), (6, 0, None, ""), (7, None, "user", "late"), (7, 0, "user", "first"),
        (None, 0, "user", "nobody"), (8, 0, "user", "twice"), (8, 0, "user", "twice"),
    ]
    df = spark.createDataFrame([(*r, "x", 9) for r in rows], "conv_id long, turn long, role string, text string, chat string, n_turns int").repartition(3)
    got = {r["conv_id"]: r for r in chat_format.collapse(df).collect()}
    assert set(got) == {2, 3, 5, 6, 7, 8}
    assert (got[2]["n_turns"], got[2]["n_same"], got[8]["n_turns"]) == (3, 2, 2)
    assert got[7]["chat"] == "<|im_start|>user\nfirst<|im_end|>\n<|im_start|>user\nlate<|im_end|>\n"
    assert got[5]["chat"] == "<|im_start|>unknown\n<|im_end|>\n"
    assert chat_format.collapse(df.limit(0)).count() == 0
    plan = chat_format.collapse(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_chat_against_brute_force(spark):
    rnd = random.Random(6)
    convs = {i: [(rnd.choice("ua"), rnd.choice("xyz")) for _ in range(rnd.randrange(1, 5))] for i in range(300)}
    df = spark.createDataFrame([(i, k, r, t) for i, c in convs.items() for k, (r, t) in enumerate(c)], "conv_id long, turn long, role string, text string")
    want = {i for i, c in convs.items() if not any(len(o) > len(c) and o[: len(c)] == c for o in convs.values()) and min(j for j, o in convs.items() if o == c) == i}
    assert {r["conv_id"] for r in chat_format.collapse(df).collect()} == want


# ---- SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, name):
    import glob
    import os

    import duckdb

    d, con = "/root/testdata/sf0.01", duckdb.connect()
    for f in glob.glob(f"{d}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    df = queries.QUERIES[name](spark, d)
    cols = sorted(df.columns)
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE_SQL[name]})").fetchall())


@pytest.mark.parametrize("most", [250_000, 300])
def test_bpe_shared_words(spark, docs, library, ranks, monkeypatch, most):
    monkeypatch.setattr(bpe, "STRETCH_ROWS", 4)
    monkeypatch.setattr(bpe, "MOST_SHARED", most)
    rows = docs.where("doc_id is not null").withColumn("stretch", F.lit(1)).withColumn("word", F.col("lang")).repartition(3).select("doc_id", "text", "stretch", "word")
    words, ids = bpe.shared_words(rows, spark.sparkContext.broadcast(ranks), queries.PATTERN)
    assert 0 < len(words) <= most and len(set(words)) == len(words)
    for w, i in zip(words, ids):
        assert np.frombuffer(i, "<u4").tolist() == library.encode_ordinary(w)
    got = bpe.encode(rows, queries.VOCABULARY, queries.PATTERN).collect()
    assert len(got) == rows.count()
    for r in got:
        assert r["stretch"] == 1 and r["ids"] == library.encode_ordinary(r["text"] or "") and r["n_tokens"] == len(r["ids"])


def test_bpe_table_holds_what_stretches_share(spark, ranks, monkeypatch):
    monkeypatch.setattr(bpe, "STRETCH_ROWS", 2)
    rows = spark.createDataFrame([("one two",), ("two three",), ("two four",), (None,), ("four five",), ("",)], "text string").coalesce(1)
    words, _ = bpe.shared_words(rows, spark.sparkContext.broadcast(ranks), queries.PATTERN)
    assert words and sorted(words) == sorted(_shared(rows, ranks))


def _shared(rows, ranks):
    """Words of two or more stretches of two rows, by a loop."""
    texts = [r["text"] or "" for r in rows.collect()]
    split = bpe.regex.compile(ranks.pattern).findall
    seen = [set(split(a)) | set(split(b)) for a, b in zip(texts[::2], texts[1::2])]
    return [w for w in set().union(*seen) if sum(w in s for s in seen) > 1]
