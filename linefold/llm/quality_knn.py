"""Quality by nearest-neighbour voting in a latent-semantic space.

Terms of a document are hashed lower-cased words, hashed 4-grams of character
shapes (letter case, digit, blank, each other sign as itself) and levels of the
shares of distinct words, of words equal to their neighbour and of repeated
lines.  Term weights (1 + log tf) * idf, of unit length for words and for the
rest apart, are projected onto the leading singular vectors of a bounded sample
of labelled documents that are not held out.  The sample's vectors are
broadcast; every document's cosines to all of them are exact products, block by
block, and the ``NEIGHBOURS`` nearest vote with their similarity as weight.

Null and empty texts have no terms, hence a zero vector: they get the score of
``EMPTY``, 0.  No label, language, source or id of a document enters its score.
Among equal cosines the earlier sample row counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from linefold.llm.common import labelled, map_texts

BUCKETS, LEVELS, WORDS = 1024, 24, 2048
SHAPES = BUCKETS + LEVELS
TERMS = SHAPES + WORDS
#: Length of the words' part of a vector against the rest.
WORD_SHARE = 0.5
RANK = 64
#: Characters that are hashed at a time.
STEP = 1 << 20
NEIGHBOURS = 15
#: Bound of the labelled sample: documents of both classes.
MAX_TRAIN_DOCS = 4_000
BLOCK = 1024
EMPTY = 0.0
_SHAPE: list[np.ndarray] = []


def _shapes() -> np.ndarray:
    """Shape class of each code point; built once a worker."""
    if not _SHAPE:
        table = np.full(0x110000, 7, np.uint8)
        for c in range(0x30000):
            ch = chr(c)
            table[c] = 1 if ch.islower() else 2 if ch.isupper() else 3 if ch.isdigit() else 4 if ch == "\n" else 5 if ch.isspace() else 6 if ch.isalpha() else 8 + c % 97
        _SHAPE.append(table)
    return _SHAPE[0]


def term_counts(texts: list[str]) -> np.ndarray:
    """Dense counts, one row a text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    full = np.array([i for i, t in enumerate(texts) if t], np.int64)
    if not len(full):
        return out
    codes = np.frombuffer("".join(texts[i] + "\n\n\n" for i in full).encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(texts[i]) + 3 for i in full])
    for at in range(0, len(codes) - 3, STEP):
        s = _shapes()[codes[at : at + STEP + 3]].astype(np.uint32)
        h = s[:-3]
        for k in (1, 2, 3):
            h = h * np.uint32(0x9E3779B1) + s[k : len(s) - 3 + k]
        h ^= h >> np.uint32(15)
        bucket = ((h * np.uint32(0x85EBCA6B)) >> np.uint32(22)).astype(np.int64)
        doc = np.searchsorted(ends, np.arange(at, at + len(bucket)), side="right")
        first, n = doc[0], doc[-1] - doc[0] + 1
        out[full[first : first + n], :BUCKETS] += np.bincount((doc - first) * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS)
    for i in full:
        w = texts[i].split()
        lines = texts[i].split("\n")
        n = max(1, len(w))
        weight = len(texts[i]) / 8  # as a few terms of the text's length
        same = sum(map(str.__eq__, w, w[1:])) / n
        shares = (len(set(w)) / n, same, 1 - len(set(lines)) / len(lines))
        for k, x in enumerate(shares):
            out[i, BUCKETS + 8 * k + min(7, int(x * 8))] = weight
        low = texts[i].lower().encode("utf-8", "surrogatepass").split()
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, low), np.uint64, len(low)) % np.uint64(WORDS)
        out[i, SHAPES:] = np.bincount(own.astype(np.int64), minlength=WORDS)
    return out


@dataclass
class Space:
    idf: np.ndarray
    basis: np.ndarray  # (TERMS, RANK)
    vectors: np.ndarray  # (n, RANK), unit length
    labels: np.ndarray


def weigh(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    for part, share in ((x[:, :SHAPES], 1.0), (x[:, SHAPES:], WORD_SHARE)):
        part *= share / np.maximum(np.linalg.norm(part, axis=1, keepdims=True), 1e-9)
    return x


def embed(space: Space, texts: list[str]) -> np.ndarray:
    v = weigh(term_counts(texts), space.idf) @ space.basis
    return (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_docs: int = MAX_TRAIN_DOCS, rank: int = RANK) -> Space | None:
    sample = labelled(docs, labels, label, max_docs).where("text != ''")
    rows = map_texts(sample, "terms binary", lambda: lambda texts: [[x.astype(np.float16).tobytes() for x in np.minimum(term_counts(texts), 60000)]], keep=["y"]).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r["terms"], r["y"]))
    counts = np.stack([np.frombuffer(r["terms"], np.float16) for r in rows]).astype(np.float32)
    idf = np.log((1 + len(counts)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    x = weigh(counts, idf)
    basis = np.random.default_rng(5).normal(size=(TERMS, rank + 8)).astype(np.float32)
    for _ in range(6):  # subspace iteration for the right singular vectors
        basis, _ = np.linalg.qr(x.T @ (x @ basis))
    small = x @ basis
    _, _, rot = np.linalg.svd(small, full_matrices=False)
    basis = (basis @ rot.T)[:, :rank].astype(np.float32)
    v = x @ basis
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)
    return Space(idf, basis, v.astype(np.float32), np.array([r["y"] for r in rows], np.float32))


def vote(space: Space, v: np.ndarray, k: int = NEIGHBOURS) -> np.ndarray:
    """Similarity-weighted share of label 1 among the k nearest, by exact products block by block."""
    best_s, best_y = np.full((len(v), 0), 0, np.float32), np.full((len(v), 0), 0, np.float32)
    for at in range(0, len(space.vectors), BLOCK):
        s = np.concatenate([best_s, v @ space.vectors[at : at + BLOCK].T], 1)
        y = np.concatenate([best_y, np.broadcast_to(space.labels[at : at + BLOCK], (len(v), min(BLOCK, len(space.labels) - at)))], 1)
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        best_s, best_y = np.take_along_axis(s, top, 1), np.take_along_axis(y, top, 1)
    w = np.maximum(best_s, 0) ** 4 + 1e-9
    return (w * best_y).sum(1) / w.sum(1)


def score(space: Space | None, texts: list[str]) -> list[float]:
    if space is None:
        return [EMPTY] * len(texts)
    got = vote(space, embed(space, texts)).astype(float) if texts else []
    return [float(s) if t else EMPTY for s, t in zip(got, texts)]


def rate(docs: DataFrame, space: Space | None, keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(space)  # MAX_TRAIN_DOCS vectors
    return map_texts(docs, "score double", lambda: lambda texts: [score(shared.value, texts)], keep=keep)
