"""How the sources of a language differ in their words: exact counts, pairs of sources, leading terms.

``CountVectorizer`` with a least document frequency and the greatest possible
vocabulary size fits the kept terms; a term carries its language as a prefix, so
that one fit gives each language a vocabulary of its own, whatever the number of
languages.  It is given each document's terms once, all that a document
frequency needs.  Every document's sparse vector is made in the tasks
from the fitted vocabulary, and summed for each (lang, source) where it is made.  Pairs are evaluated from the terms that occur: a term that
neither source has adds the same constant to their sum.

The model's vocabulary is the one thing that the driver and each executor hold.
Terms are dealt by hash into as many blocks as keep it at about ``MOST_TERMS``
(its size is told from the exact document frequencies of one part of the terms
by hash); each block is a fit of its own over the table of terms, and its sums
join the others.  The number of blocks changes no result.

A term is a run of A-Z, a-z and characters beyond 127, A-Z in lower case.
Null text, lang and source count as ''.  A document without terms still gives
its group, all of whose counts are 0; a language without a kept term has pairs
of value 0.  Repeated rows count each; further columns are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import map_texts, slices, written
from linefold.session import Workspace

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
#: Kept terms of a block, and so of one vocabulary, by estimate; the part of the terms that it comes from.
MOST_TERMS, PROBE = 2_000_000, 64
#: Sums of vectors that a task holds at a time; indices of a piece of them; bytes of text of a step.
MOST_SUMS, PIECE, STEP_BYTES = 2_000_000, 4_096, 3_000_000
#: Terms x sources of one step of the pair evaluation.
CELLS = 200_000
#: Between language and term; no term holds it.
_MARK = "\x00"


#: Each byte as it counts: a small letter or part of a character beyond 127, or 32 if it is no part of a term.
_BYTES = np.array([b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)], np.uint8)
#: Odd factors of a term's bytes by their place: 64-bit hashes that tell the terms of a text apart.
_FACTORS = np.random.default_rng(11).integers(1, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def split(texts: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All terms of the texts: their bytes one after the other, the ends of the terms in them, and the row of each."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    data = _BYTES[raw]
    inside = data != 0x20
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cut = ends[:-1][ends[:-1] < len(inside)]
    first[cut] |= inside[cut]  # a text begins a term of its own
    starts = np.flatnonzero(first)
    row = np.searchsorted(ends, starts, side="right") - 1
    kept = np.cumsum(inside, dtype=np.int32)
    return data[inside], np.append(kept[starts[1:] - 1] if len(starts) > 1 else kept[:0], kept[-1:] if len(starts) else kept[:0]), row


def _binary(data: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.append(0, ends).astype(np.int32)
    return pa.Array.from_buffers(kind, len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _texts(part: pa.RecordBatch) -> pa.BinaryArray:
    return part.column("text").fill_null("").cast(pa.binary())


def _splitter():
    """Each text's terms, once each and behind its language, and those of them in one of ``PROBE`` parts by hash."""

    def prefixed(texts: pa.BinaryArray, mark: bytes) -> tuple[pa.Array, pa.Array]:
        data, ends, row = split(texts)
        n, lengths = len(texts), np.diff(ends, prepend=0)
        term = np.repeat(np.arange(len(ends), dtype=np.int32), lengths)
        place = np.arange(len(data), dtype=np.int32) - (ends - lengths).astype(np.int32)[term]
        hashed = np.add.reduceat(data.astype(np.uint64) * _FACTORS[place % 64], ends - lengths) if len(ends) else np.zeros(0, np.uint64)
        once = np.zeros(len(ends), bool)  # a text's terms once each
        once[np.unique(hashed ^ (row.astype(np.uint64) + np.uint64(1)) * _FACTORS[0], return_index=True)[1]] = True
        mine = once[term]
        data, place, lengths, row, hashed = data[mine], place[mine], lengths[once], row[once], hashed[once]
        term = np.repeat(np.arange(len(row), dtype=np.int32), lengths)
        begin = np.cumsum(lengths) - lengths + len(mark) * np.arange(len(row))
        whole = np.empty(len(data) + len(mark) * len(row), np.uint8)
        whole[begin[:, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
        whole[begin[term] + len(mark) + place] = data
        terms = _binary(whole, begin + len(mark) + lengths, pa.string())

        def lists(rows: np.ndarray, values: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.bincount(rows, minlength=n))).astype(np.int32)), values)

        chosen = np.flatnonzero((hashed >> np.uint64(40)) % np.uint64(PROBE) == 0)
        return lists(row, terms), lists(row[chosen], terms.take(pa.array(chosen)))

    def run(part: pa.RecordBatch) -> list:
        texts, lang = _texts(part), part.column("lang")
        rows, made = [], []
        for name in lang.unique().to_pylist():
            at = np.flatnonzero(pc.equal(lang, name).to_numpy(zero_copy_only=False))
            rows.append(at)
            made.append(prefixed(texts.take(pa.array(at)), (name + _MARK).encode()))
        back = pa.array(np.argsort(np.concatenate(rows)))
        return [pa.concat_arrays([m[k] for m in made]).take(back) for k in (0, 1)]

    return run


def _plain(docs: DataFrame) -> DataFrame:
    lang, source = (F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))
    return docs.select(lang, source, "text")


def term_rows(docs: DataFrame) -> DataFrame:
    """lang, terms (of each text once, behind its language), probe: all that a vocabulary by document frequency needs."""
    return map_texts(_plain(docs), "terms array<string>, probe array<string>", _splitter, keep=["lang"], rows=True)


def vocabulary(rows: DataFrame, least_docs: int) -> tuple[dict[str, pa.Array], list[str]]:
    """Of each language its kept terms with their indices, and all tokens in the order of the indices."""
    # a term of no language that is always frequent enough: the estimator refuses an empty vocabulary
    stand_in = rows.sparkSession.range(least_docs).select(F.array(F.lit("")).alias("terms"))
    made = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(least_docs), vocabSize=2**31 - 1).fit(rows.select("terms").unionByName(stand_in))
    tokens = made.vocabulary
    of_lang: dict[str, tuple[list, list]] = {}
    for i, token in enumerate(tokens):
        lang, mark, term = token.rpartition(_MARK)
        if mark:
            terms, places = of_lang.setdefault(lang, ([], []))
            terms.append(term.encode())
            places.append(i)
    return {k: (pa.array(t, pa.binary()), np.array(i, np.int32)) for k, (t, i) in of_lang.items()}, tokens


def vectors(texts: pa.BinaryArray, terms: pa.BinaryArray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The exact sparse vectors of texts of one language: row, index and count of every kept term that occurs, by row and index.

    They are those that the fitted model's own ``transform`` makes of the same texts.
    """
    data, ends, row = split(texts)
    found = pc.index_in(_binary(data, ends, pa.binary()), value_set=terms)
    has = found.is_valid().to_numpy(zero_copy_only=False)
    cell, n = np.unique(row[has] * 2**32 + index[found.drop_null().to_numpy()], return_counts=True)
    return cell >> 32, cell & (2**32 - 1), n


def _summer(shared):
    """Sums of a task's vectors by (lang, source), as pieces of ``PIECE`` indices; handed on whenever ``MOST_SUMS`` have gathered."""

    def run(batches):
        of_lang, held = shared.value, {}

        def merged(parts: list[np.ndarray]) -> np.ndarray:
            idx, at = np.unique(np.concatenate([x[0] for x in parts]), return_inverse=True)
            total = np.zeros(len(idx), np.int64)
            np.add.at(total, at, np.concatenate([x[1] for x in parts]))
            return np.stack([idx, total])

        def rows():
            names, cols = ["lang", "source", "piece", "idx", "n"], [[] for _ in range(5)]
            for (lang, source), parts in held.items():
                idx, n = merged(parts)
                piece, at = np.unique(idx // PIECE, return_index=True)
                for p, i, k in zip(piece.tolist(), np.split(idx, at[1:]), np.split(n, at[1:])):
                    for c, v in zip(cols, (lang, source, p, i, k)):
                        c.append(v)
            kinds = [pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        def size():
            return sum(x.shape[1] for parts in held.values() for x in parts)

        for batch in batches:
            for part in slices(batch, "text", STEP_BYTES):
                texts, lang, source = _texts(part), part.column("lang"), np.array(part.column("source").to_pylist(), object)
                for name in lang.unique().to_pylist():
                    if name not in of_lang:
                        continue
                    at = np.flatnonzero(pc.equal(lang, name).to_numpy(zero_copy_only=False))
                    row, idx, n = vectors(texts.take(pa.array(at)), *of_lang[name])
                    names, code = np.unique(source[at].astype(str), return_inverse=True)
                    by = np.argsort(code[row], kind="stable")
                    for k, own in zip(*(lambda c: (c, np.split(by, np.flatnonzero(np.diff(code[row][by])) + 1)))(np.unique(code[row]).tolist())):
                        held.setdefault((name, str(names[k])), []).append(merged([np.stack([idx[own], n[own]])]))
                if size() > MOST_SUMS:
                    held = {k: [merged(parts)] for k, parts in held.items()}
                    if size() > MOST_SUMS // 2:
                        yield rows()
                        held = {}
        yield rows()

    return run


def _pieces_added(batches):
    """Rows come sorted by (lang, source, piece): the pieces of a key are added one by one."""
    key, total, out = None, np.zeros(PIECE, np.int64), []

    def done():
        at = np.flatnonzero(total)
        made = [pa.array([key[0]] * len(at), pa.string()), pa.array([key[1]] * len(at), pa.string()), pa.array(at + key[2] * PIECE, pa.int32()), pa.array(total[at])]
        return pa.RecordBatch.from_arrays(made, ["lang", "source", "idx", "n"])

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("lang", "source", "piece")), b.column("idx"), b.column("n")):
            if row[:3] != key:
                if key is not None:
                    yield done()
                key, total = row[:3], np.zeros(PIECE, np.int64)
            total[row[3].values.to_numpy() - key[2] * PIECE] += row[4].values.to_numpy()
    if key is not None:
        yield done()


def counts(docs: DataFrame, work: Workspace, least_docs: int = LEAST_DOCS, most_terms: int = MOST_TERMS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, source) of all groups; (lang, source, block, idx, n) of the kept terms that occur in them; (block, idx, term) of the vocabularies."""
    spark, docs = docs.sparkSession, _plain(docs)
    groups = work.written(docs.select("lang", "source").distinct(), "groups")
    rows = work.written(term_rows(docs), "terms")
    frequent = rows.select(F.explode("probe").alias("t")).groupBy("t").count().where(F.col("count") >= least_docs).count()
    blocks = max(1, math.ceil(PROBE * frequent / most_terms))
    sums, names = [], []
    for b in range(blocks):
        mine = rows if blocks == 1 else rows.withColumn("terms", F.filter("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(blocks)) == b))
        of_lang, tokens = vocabulary(mine, least_docs)
        shared = spark.sparkContext.broadcast(of_lang)
        pieces = docs.mapInArrow(_summer(shared), "lang string, source string, piece int, idx array<int>, n array<long>")
        key = ["lang", "source", "piece"]
        cells = pieces.repartition(*key).sortWithinPartitions(*key).mapInArrow(_pieces_added, "lang string, source string, idx int, n long")
        sums.append(work.written(cells.withColumn("block", F.lit(b)), "sums"))
        shared.unpersist()
        own = pa.table({"idx": pa.array(range(len(tokens)), pa.int32()), "term": pa.array([t.rpartition(_MARK)[2] for t in tokens], pa.string())})
        names.append(work.written(spark.createDataFrame(own).withColumn("block", F.lit(b)), "names"))
    return groups, reduce(DataFrame.unionByName, sums), reduce(DataFrame.unionByName, names)


def share(n: str, total: str, terms: str):
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)); null without terms."""
    parts = f"nullif({total} + 2 * {terms}, 0)"
    wide = f"(cast({n} + 2 as decimal(28,0)) * {SCALE}) div cast({parts} as decimal(28,0))"
    whole = F.expr(f"case when {n} < 9000000000 then (({n} + 2) * {SCALE}L) div {parts} else {wide} end")  # 64 bits hold the product up to there
    return F.when(F.col(terms) > 0, 1 + whole)


def gain(p: str, q: str):
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def _pair_sums(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
    """For a block of terms, how far each pair's sum differs from that of terms which neither source has."""
    names = groups.column("source").to_pylist()
    none = groups.column("p0").to_numpy().astype(np.int64)
    place = {s: i for i, s in enumerate(names)}
    _, term = np.unique(cells.column("at").to_numpy(), return_inverse=True)
    own = np.array([place[x] for x in cells.column("source").to_pylist()], np.int64)
    p = np.tile(none, (int(term.max()) + 1 if len(term) else 0, 1))
    has = np.zeros(p.shape, bool)
    p[term, own] = cells.column("p").to_numpy()
    has[term, own] = True

    def f(a, b):
        return (a - b) ** 2 // (a + b)

    one, both = (np.zeros((len(names), len(names)), np.int64) for _ in range(2))
    for s in range(len(names)):
        t = term[own == s]  # the terms that s has, against all sources
        more = f(p[t, s][:, None], p[t]) - f(none[s], none)[None, :]
        one[s], both[s] = more.sum(0), (more * has[t]).sum(0)
    differ = one + one.T - both
    a, b = np.nonzero(differ)
    names = pa.array(names, pa.string())
    return pa.table({"lang": pa.array([key[0].as_py()] * len(a), pa.string()), "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "more": differ[a, b]})


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, most_terms: int = MOST_TERMS) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: as the module says, with all pairs and the leading terms of each group."""
    spark = docs.sparkSession
    with Workspace(spark, "divergence") as work:
        groups, cells, names = counts(docs, work, least_docs, most_terms)
        at = ["block", "idx"]
        of_term = work.written(cells.groupBy(*at, "lang").agg(F.sum("n").alias("all_n")), "of-term")
        of_lang = of_term.groupBy("lang").agg(F.count("*").alias("n_terms"), F.sum("all_n").alias("all_total"))
        total = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
        sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
        facts = groups.join(total, ["lang", "source"], "left").join(of_lang, "lang", "left").join(sources, "lang").fillna(0, ["total", "n_terms", "all_total"])
        # a block of terms times sources is one step of the pairs
        facts = facts.withColumn("p0", share("0", "total", "n_terms")).withColumn("steps", F.ceil(F.col("n_terms") * F.col("n_sources") / CELLS))
        facts = work.written(facts, "facts")
        shares = cells.join(facts, ["lang", "source"]).withColumn("p", share("n", "total", "n_terms"))

        dealt = shares.select("lang", F.pmod(F.xxhash64(*at), "steps").alias("step"), "source", (F.col("block").cast("long") * 2**32 + F.col("idx")).alias("at"), "p")
        beside = facts.where("steps > 0").select("lang", F.explode(F.expr("sequence(0L, steps - 1)")).alias("step"), "source", "p0")
        key = ["lang", "step"]
        sums = dealt.groupBy(*key).cogroup(beside.groupBy(*key)).applyInArrow(_pair_sums, "lang string, source string, item string, more long")
        sums = sums.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
        other = facts.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
        pairs = facts.select("lang", "source", "p0", "n_terms").join(other, "lang").where("source != item").join(sums, ["lang", "source", "item"], "left")
        value = F.coalesce(F.col("n_terms") * gain("p0", "q0"), F.lit(0)) + F.coalesce("more", F.lit(0))
        pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value"))

        group = Window.partitionBy("lang", "source")
        terms = shares.join(of_term.drop("lang"), at).withColumn("q", share("all_n", "all_total", "n_terms")).where("p > q")
        terms = terms.select("lang", "source", *at, gain("p", "q").alias("value"))
        # the leading values of a group with all their ties; only those are named
        terms = terms.withColumn("_k", F.rank().over(group.orderBy(F.desc("value")))).where(F.col("_k") <= top_terms)
        terms = terms.join(names, at).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")

        def ranked(rows: DataFrame) -> DataFrame:
            return rows.withColumn("rank", F.row_number().over(group.orderBy(F.desc("value"), "item")))

        return written(ranked(pairs).unionByName(ranked(terms).where(F.col("rank") <= top_terms)), "divergence")
