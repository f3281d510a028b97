"""Benchmark decontamination by broadcast sets of normalised n-grams.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
lower-cased.  A benchmark item gives its windows of 13 consecutive words; a
shorter item that has words is one window.  Each training document is scanned
window by window against the n-gram set; a hash hit is verified word for word.
A word inside any occurrence of a window is hit.

The set is broadcast in blocks of at most ``BLOCK_WORDS`` benchmark words.  A
block is a few arrays (hashes of the windows in order, a bitmap of them, and
the words), built once on the driver, that a worker uses as they come: about
30 bytes a word.  A worker holds at most ``HELD_WORDS`` words of blocks; beyond
that the blocks take turns over each slice of a partition, each read anew from
the worker's local copy of the broadcast, so a larger benchmark costs time, but
neither memory nor a shuffle.

Null and empty texts have no words, are never contaminated, and as items give
no window.  Items with a null id are left out.  Repeated items count once.
"""

from __future__ import annotations

import hashlib
from itertools import pairwise

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import map_texts

WINDOW = 13
#: Benchmark words in one broadcast block; also the most that the driver holds at once.
BLOCK_WORDS = 1_000_000
#: Benchmark words whose blocks a worker keeps.
HELD_WORDS = 2_000_000
#: A document is contaminated if it has hits and ``RATIO`` times its hit words reach its words.
RATIO = 20
#: Each byte as word character (lower-cased) or blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TABLE).split()


def _word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n consecutive words at each position."""
    g = np.zeros(max(0, len(h) - n + 1), np.uint64)
    for k in range(n):
        g = g * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(g)]
    g ^= g >> np.uint64(32)
    g *= np.uint64(0xD6E8FEB86659FD93)
    return g ^ (g >> np.uint64(32))


class NgramSet:
    """The windows of a block of items, as arrays."""

    def __init__(self, items: list[tuple[int, str]], window: int = WINDOW):
        split = [(i, w) for i, w in ((i, words(t)) for i, t in items) if w]
        self.items = [i for i, _ in split]
        self.first = np.cumsum([0] + [len(w) for _, w in split])  # of each item's words
        flat = [x for _, w in split for x in w]
        self.n_words = len(flat)
        self.text = b" ".join(flat)
        self.offset = np.cumsum([0] + [len(x) + 1 for x in flat])
        h = _word_hashes(flat)
        sizes = np.minimum(np.diff(self.first), window)
        self.by_length = {}
        for n in np.unique(sizes).tolist():
            at = np.concatenate([np.arange(a, b - n + 1) for (a, b), m in zip(pairwise(self.first.tolist()), sizes) if m == n])
            g = _window_hashes(h, n)[at]
            order = np.argsort(g, kind="stable")
            g, at = g[order], at[order]
            bits = max(16, min(27, 4 + len(g).bit_length()))
            seen = np.zeros(1 << bits, bool)
            seen[(g >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.by_length[n] = (g, at, np.packbits(seen), bits)

    def __len__(self) -> int:
        return self.n_words

    def _owners(self, gram: bytes, at: np.ndarray, n: int) -> set:
        """The items that hold the very words of a window among the places of its hash."""
        same = [p for p in at.tolist() if self.text[self.offset[p] : self.offset[p + n] - 1] == gram]
        return {self.items[k] for k in np.searchsorted(self.first, same, side="right") - 1}

    def scan(self, docs: list[list[bytes]], h: np.ndarray) -> dict[int, tuple[np.ndarray, set]]:
        """For each document (by position) with occurrences: its hit words as a mask, and the items.  ``h`` holds all words' hashes."""
        out: dict[int, tuple[np.ndarray, set]] = {}
        sizes = np.array([len(d) for d in docs])
        ends = np.cumsum(sizes)
        for n, (grams, places, packed, bits) in self.by_length.items():
            g = _window_hashes(h, n)
            slot = (g >> np.uint64(64 - bits)).astype(np.int64)
            at = np.flatnonzero(packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1)
            low, high = np.searchsorted(grams, g[at]), np.searchsorted(grams, g[at], side="right")
            at, low, high = (x[low < high] for x in (at, low, high))
            owners: dict[bytes, set] = {}
            for p, a, b, d in zip(at.tolist(), low.tolist(), high.tolist(), np.searchsorted(ends, at, side="right").tolist()):
                start = int(ends[d] - sizes[d])
                if p + n > ends[d]:
                    continue  # spans two documents
                gram = b" ".join(docs[d][p - start : p - start + n])
                if gram not in owners:
                    owners[gram] = self._owners(gram, places[a:b], n)
                if owners[gram]:
                    mask, items = out.setdefault(d, (np.zeros(sizes[d], bool), set()))
                    mask[p - start : p - start + n] = True
                    items |= owners[gram]
        return out


def blocks_of(items: DataFrame, id_col: str = "item_id", text: str = "text", block_words: int = BLOCK_WORDS) -> list:
    """The items as broadcast sets of at most ``block_words`` words each (a longer item is a block of its own)."""
    spark = items.sparkSession
    rows = items.where(f"`{id_col}` is not null and `{text}` is not null").select(F.col(id_col), F.col(text)).distinct().toLocalIterator()
    out, held, n = [], [], 0

    def send():
        made = NgramSet(held)
        out.append((len(made), spark.sparkContext.broadcast(made)))

    for row in rows:
        size = len(words(row[1]))
        if held and n + size > block_words:
            send()
            held, n = [], 0
        held.append((row[0], row[1]))
        n += size
    if held:
        send()
    return out


def _sets(blocks):
    """The sets in turn; those beyond ``HELD_WORDS`` are not kept."""
    total = 0
    for n, block in blocks:
        total += n
        yield block.value if total <= HELD_WORDS else block.load_from_path(block._path)


def _hits(blocks, texts: list[str]) -> tuple[list[list[bytes]], dict]:
    docs, found = [words(t) for t in texts], {}
    h = _word_hashes([w for d in docs for w in d])
    for grams in _sets(blocks):
        for d, (mask, items) in grams.scan(docs, h).items():
            m, x = found.setdefault(d, (np.zeros(len(docs[d]), bool), set()))
            m |= mask
            x |= items
    return docs, found


def scan(docs: DataFrame, blocks: list, keep: list[str] | None = None) -> DataFrame:
    """Append n_words, n_hit, items (sorted as strings), contaminated; a row per input row."""

    def make():
        def fn(texts):
            split, found = _hits(blocks, texts)
            n_words = [len(d) for d in split]
            n_hit = [int(found[i][0].sum()) if i in found else 0 for i in range(len(split))]
            items = [sorted(map(str, found[i][1])) if i in found else [] for i in range(len(split))]
            return n_words, n_hit, items, [h > 0 and RATIO * h >= n for h, n in zip(n_hit, n_words)]

        return fn

    return map_texts(docs, "n_words long, n_hit long, items array<string>, contaminated boolean", make, keep=keep)


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def _cut(text: str, mask: np.ndarray) -> str:
    """The text without its masked words; other characters stay as they are."""
    raw, out, at, p = text.encode("utf-8", "surrogatepass"), [], 0, 0
    low = raw.translate(TABLE)
    for hit, w in zip(mask.tolist(), low.split()):
        p = low.index(w, p)
        if hit:
            out.append(raw[at:p])
            at = p + len(w)
        p += len(w)
    return b"".join([*out, raw[at:]]).decode("utf-8", "surrogatepass")


def clean(docs: DataFrame, blocks: list) -> DataFrame:
    """The documents that are not contaminated, without the words that are hit; null texts stay null."""

    def make():
        def fn(texts):
            split, found = _hits(blocks, texts)
            drop = [i in found and RATIO * int(found[i][0].sum()) >= len(split[i]) for i in range(len(texts))]
            return drop, [_cut(t, found[i][0]) if i in found and not drop[i] else t for i, t in enumerate(texts)]

        return fn

    made = map_texts(docs, "contaminated_ boolean, cleaned_ string", make)
    return made.where("not contaminated_").withColumn("text", F.when(F.col("text").isNotNull(), F.col("cleaned_"))).select(*docs.columns)
