"""Language identification with language-bitmask n-gram filters.

A filter is a table of slots; each slot holds one bit per language.  Every
character n-gram of a language sets that language's bit in ``HASHES`` slots.
Looking up an n-gram ANDs its slots, which gives at once the set of all
languages that contain it (up to false positives, whose rate per language is
known from the fill of its bits).  A document is decided by per-language
popcounts over its n-grams, each weighted by one over the number of languages
that were returned for it, and corrected for those false positives.  A second
filter of the same kind holds n-grams for the languages that they are typical
of; both counts are added, so that a passage in another language, which puts
its n-grams into the first filter, weighs little.

Null, empty and letterless texts give ``und`` with score 0.  A text with
letters but no known n-gram gets the most frequent training language with
score 0.  Ties go to the language that sorts first.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import held_out, map_texts, slices, thinned

#: Least and most bits of a slot's number; a filter has ``ROOM`` slots for each n-gram of its largest language, as far as the most bits go.
SLOT_BITS, MOST_SLOT_BITS = 18, 22
ROOM = 8
HASHES = 3
#: Training documents to learn from, about: rows are thinned by a hash of their id and text.
MAX_TRAIN_DOCS = 20_000
#: An n-gram is typical of a language if this share of its documents has it ...
MIN_DOC_SHARE = 0.01
#: ... and the language has at least this share of the n-gram's summed document shares.
MIN_LANG_SHARE = 0.4
#: Language bits in one word of a slot; more languages use more words.
WORD = 62


@dataclass
class LanguageModel:
    langs: list[str]
    prior: str
    slots: np.ndarray  # uint64 (words, 2 ** bits)
    false_rate: np.ndarray
    bits: int
    typical: np.ndarray  # as slots
    typical_false_rate: np.ndarray


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(29))


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the letter 4-grams (word edges count as one blank), the document of each, and whether each document has a letter."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer((" " + " ".join(lowered) + "  ").encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    ends = np.cumsum([len(t) + 1 for t in lowered])
    has = np.add.reduceat(letter, np.concatenate([[0], ends[:-1]]) + 1, dtype=np.int64) > 0 if texts else np.zeros(0, bool)
    at = np.flatnonzero(letter[1:-2] & letter[2:-1])
    chars = np.where(letter, codes, 32).astype(np.uint64)
    h = chars[at] * np.uint64(0x9E3779B97F4A7C15)
    for k, m in enumerate((0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5), 1):
        h += chars[at + k] * np.uint64(m)
    return _mix(h), np.searchsorted(ends, at, side="right"), has


def _slots(h: np.ndarray, bits: int = SLOT_BITS) -> list[np.ndarray]:
    return [((h >> np.uint64(k * 20)) & np.uint64((1 << bits) - 1)).astype(np.int64) for k in range(HASHES)]


def _count_grams(batches):
    """(lang, gram, number of documents with it) of each slice of a partition; a null gram counts the documents."""
    for batch in batches:
        for part in slices(batch, "text", 4_000_000):
            langs, texts = part.column("lang").to_pylist(), part.column("text").to_pylist()
            for lang in dict.fromkeys(langs):
                own = [t for t, x in zip(texts, langs) if x == lang]
                h, doc, _ = ngrams(own)
                order = np.lexsort((h, doc))
                h, doc = h[order], doc[order]
                first = np.ones(len(h), bool)
                first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
                gram, n = np.unique(h[first], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * (len(gram) + 1)), pa.array([None, *gram.view(np.int64).tolist()], pa.int64()), pa.array([len(own), *n.tolist()], pa.int64())],
                    ["lang", "gram", "n"],
                )


def fit(docs: DataFrame, max_train_docs: int = MAX_TRAIN_DOCS) -> LanguageModel | None:
    """Learn from text and non-null lang of the documents that are not held out; None if there are none."""
    train = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    total = train.select("doc_id").count()
    if not total:
        return None
    train = thinned(train, total, max_train_docs)
    counts = train.select("lang", "text").mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.persist()
    try:
        docs_of = {r["lang"]: r["n"] for r in counts.where("gram is null").collect()}
        langs = sorted(docs_of)
        if not langs:
            return None
        bit = F.create_map(*[x for i, name in enumerate(langs) for x in (F.lit(name), F.lit(i))])
        grams = counts.where("gram is not null")
        most = grams.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
        width = min(MOST_SLOT_BITS, max(SLOT_BITS, (ROOM * most - 1).bit_length()))
        size = F.create_map(*[x for name in langs for x in (F.lit(name), F.lit(float(docs_of[name])))])
        share = grams.select("gram", bit[F.col("lang")].alias("bit"), (F.col("n") / size[F.col("lang")]).alias("share"))
        by_gram = share.groupBy("gram").agg(F.sum("share").alias("all"), F.collect_list(F.struct("bit", "share")).alias("by")).select("gram", "all", F.explode("by").alias("x")).select("gram", "all", "x.*")
        slots = _filter(share, len(langs), width)
        typical = _filter(by_gram.where((F.col("share") >= MIN_DOC_SHARE) & (F.col("share") >= MIN_LANG_SHARE * F.col("all"))), len(langs), width)
    finally:
        counts.unpersist()
    prior = max(langs, key=lambda x: (docs_of[x], x))
    return LanguageModel(langs, prior, slots, _false_rate(slots, len(langs)), width, typical, _false_rate(typical, len(langs)))


def _filter(known: DataFrame, n_langs: int, width: int) -> np.ndarray:
    """The slots with the bits of all (gram, bit)."""
    at = F.explode(F.array(*[F.shiftrightunsigned("gram", k * 20).bitwiseAND(F.lit((1 << width) - 1)) for k in range(HASHES)]))
    masks = known.select(at.alias("slot"), F.floor(F.col("bit") / WORD).alias("word"), F.expr(f"shiftleft(1L, int(bit % {WORD}))").alias("mask"))
    filled = masks.groupBy("slot", "word").agg(F.bit_or("mask").alias("mask")).toArrow()  # at most the slots of the filter
    slots = np.zeros((-(-n_langs // WORD), 1 << width), np.uint64)
    slots[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64)
    return slots


def _false_rate(slots: np.ndarray, n_langs: int) -> np.ndarray:
    return np.array([((slots[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1)).mean() for i in range(n_langs)]) ** HASHES


def predict(model: LanguageModel | None, texts: list[str]) -> tuple[list[str], list[float]]:
    h, doc, has = ngrams(texts)
    if model is None or not texts:
        return ["und"] * len(texts), [0.0] * len(texts)
    at = _slots(h, model.bits)
    n = np.bincount(doc, minlength=len(texts))
    est = np.zeros((len(model.langs), len(texts)))
    for slots, false_rate in ((model.slots, model.false_rate), (model.typical, model.typical_false_rate)):
        masks = [w[at[0]] & w[at[1]] & w[at[2]] for w in slots]
        weight = 1 / np.maximum(sum(np.bitwise_count(m).astype(np.int64) for m in masks), 1)
        known = np.logical_or.reduce([m > 0 for m in masks])
        every = np.bincount(doc[known], weight[known], minlength=len(texts))
        for i, p in enumerate(false_rate):
            own = ((masks[i // WORD] >> np.uint64(i % WORD)) & np.uint64(1)).astype(bool)
            hits = np.bincount(doc[own], weight[own], minlength=len(texts))
            est[i] += np.clip((hits - p * every) / max(1 - p, 1e-9) / np.maximum(n, 1), 0, 1)
    best, total = est.argmax(0), est.sum(0)
    lang = [("und" if not ok else model.langs[b] if s > 0 else model.prior) for ok, b, s in zip(has, best, total)]
    score = [float(est[b, i] / s) if ok and s > 0 else 0.0 for i, (ok, b, s) in enumerate(zip(has, best, total))]
    return lang, score


def identify(docs: DataFrame, model: LanguageModel | None, keep: list[str] | None = None) -> DataFrame:
    """Append ``lang_pred`` and ``score``; one output row per input row, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most 2 ** MOST_SLOT_BITS words for 62 languages
    return map_texts(docs, "lang_pred string, score double", lambda: lambda texts: predict(shared.value, texts), keep=keep)
