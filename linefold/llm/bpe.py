"""Byte-level BPE by corpus-level merge replay.

The corpus is taken in stretches of ``STRETCH_ROWS`` rows.  A first pass lists
the distinct words (matches of the split pattern) of every stretch and counts
in how many stretches each word is.  Words of two or more form the corpus'
table, ``MOST_SHARED`` at most: the most widespread, by the counts of the whole
corpus.  They are laid out as one array of byte tokens, partition by partition
of the table.  An inverted index from merged token to the positions of its
pairs drives the replay: merges are applied in rank order, each at all its
positions at once, and only the neighbours of merged positions get new index
entries.  The table with its ids is broadcast.  Token ids are ranks.

A second pass looks words up.  Words that are not in the table, those of one
stretch and the less widespread ones beyond its bound, are replayed in the same
way where they are met: the bound decides where a word is replayed, not what
comes out.

Replaying by rank equals merging the lowest rank of each word first, its
leftmost pair first.  A token that ranks above some token it is a part of
(``Ranks.turning``) can make a pair of lower rank, which has to go first: its
merges are applied to one pair of a word at a time.

Null and empty texts have no tokens.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import map_texts, slices
from linefold.session import Workspace

#: Words of the broadcast table.
MOST_SHARED = 250_000
#: Further words that a worker remembers.
MAX_WORDS = 150_000
#: Rows of a stretch; a power of two.
STRETCH_ROWS = 8_192
#: Distinct words of a stretch that are held at a time.
STRETCH_WORDS = 500_000
#: Characters of text that a step holds at a time.
STEP_CHARS = 2_500_000
NEVER = np.int32(2**31 - 1)


@dataclass
class Ranks:
    pattern: str
    tokens: list[bytes]
    byte_id: np.ndarray  # id of each byte
    pairs: np.ndarray  # sorted left << 32 | right
    merged: np.ndarray  # the token of each pair
    turning: set[int]  # tokens that rank above one that they are a part of


def load(path: str, pattern: str) -> Ranks:
    """Ranks from lines of base64 token and number."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())}
    tokens = [b""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        tokens[r] = t
    pairs, turning = {}, set()
    for t, r in ranks.items():
        for k in range(1, len(t)):
            a, b = ranks.get(t[:k]), ranks.get(t[k:])
            if a is not None and b is not None:
                pairs[a << 32 | b] = r
                turning |= {x for x in (a, b) if x > r}
    keys = np.array(sorted(pairs), np.int64)
    return Ranks(pattern, tokens, np.array([ranks[bytes([b])] for b in range(256)], np.int64), keys, np.array([pairs[k] for k in keys.tolist()], np.int32), turning)


def _merged(ranks: Ranks, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    key = left << 32 | right
    at = np.minimum(np.searchsorted(ranks.pairs, key), len(ranks.pairs) - 1)
    return np.where(ranks.pairs[at] == key, ranks.merged[at], NEVER)


def replay(ranks: Ranks, words: list[bytes]) -> list[bytes]:
    """The ids of each word as little-endian unsigned 32-bit integers."""
    data = np.frombuffer(b"".join(words), np.uint8)
    n = len(data)
    if not n:
        return [b""] * len(words)
    ends = np.cumsum([len(w) for w in words])
    token = ranks.byte_id[data]
    after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
    after[ends[ends > 0] - 1] = -1
    before[np.concatenate([[0], ends[:-1]])[np.diff(ends, prepend=0) > 0]] = -1
    alive = np.ones(n, bool)
    to = np.full(n, NEVER, np.int32)  # what the pair that starts here merges to
    first = np.flatnonzero(after >= 0)
    to[first] = _merged(ranks, token[first], token[first + 1])
    index: dict[int, list[np.ndarray]] = {}
    queue: list[int] = []

    def post(at: np.ndarray) -> None:
        made = to[at]
        at, made = at[made != NEVER], made[made != NEVER]
        if not len(at):
            return
        order = np.argsort(made, kind="stable")
        at, made = at[order], made[order]
        cut = np.flatnonzero(made[1:] != made[:-1]) + 1
        for r, group in zip(made[np.concatenate([[0], cut])].tolist(), np.split(at, cut) if len(cut) else [at]):
            if r in index:
                index[r].append(group)
            else:
                index[r] = [group]
                heapq.heappush(queue, r)

    post(first)
    while queue:
        r = heapq.heappop(queue)
        at = index.pop(r)
        at = np.unique(np.concatenate(at)) if len(at) > 1 else np.sort(at[0])
        at = at[alive[at] & (to[at] == r)]
        if not len(at):
            continue
        right = after[at]
        if r in ranks.turning:
            word = np.searchsorted(ends, at, side="right")
            later = np.concatenate([[False], word[1:] == word[:-1]])
            if later.any():
                index[r] = [at[later]]
                heapq.heappush(queue, r)
                at, right = at[~later], right[~later]
        elif (right[:-1] == at[1:]).any():  # pairs that overlap: the leftmost first
            keep, last = [], -1
            for k, (a, b) in enumerate(zip(at.tolist(), right.tolist())):
                if a != last:
                    keep.append(k)
                    last = b
            at, right = at[keep], right[keep]
        token[at] = r
        alive[right] = False
        nxt = after[right]
        after[at] = nxt
        before[nxt[nxt >= 0]] = at[nxt >= 0]
        to[at] = NEVER
        has = nxt >= 0
        to[at[has]] = _merged(ranks, token[at[has]], token[nxt[has]])
        left = before[at]
        left = left[left >= 0]
        to[left] = _merged(ranks, token[left], token[after[left]])
        post(np.concatenate([at, left]))
    ids = token[alive].astype("<u4")
    stop = np.cumsum(alive)[ends - 1] * 4
    flat, out, at = ids.tobytes(), [], 0
    for w, e in zip(words, stop.tolist()):
        out.append(flat[at:e] if w else b"")
        at = e if w else at
    return out


class Encoder:
    """Knows the words of ``table`` and remembers further ones."""

    def __init__(self, ranks: Ranks, table: tuple[list[str], list[bytes]] = ((), ())):
        self.ranks, self.split, self.table = ranks, regex.compile(ranks.pattern).findall, table
        self.known = dict(zip(*table))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        split = [self.split(t) for t in texts]
        new = set().union(*split).difference(self.known) if split else set()
        if len(self.known) + len(new) > len(self.table[0]) + MAX_WORDS:
            self.known = dict(zip(*self.table))
            new = set().union(*split).difference(self.known)
        new = list(new)
        self.known.update(zip(new, replay(self.ranks, [w.encode("utf-8", "surrogatepass") for w in new])))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_encoders: dict[str, Encoder] = {}


def _encoder(name: str, ranks, table) -> Encoder:
    """One a worker, so that later tasks know the words of earlier ones."""
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(ranks.value, table.value)
    return _encoders[name]


def _words(docs: DataFrame, pattern: str) -> DataFrame:
    """(word): the distinct words of each stretch; one with more than ``STRETCH_WORDS`` counts as several."""

    def run(batches):
        split, held, seen = regex.compile(pattern).findall, None, set()

        def found():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], ["word"])

        for batch in batches:
            for part in slices(batch, "text", STEP_CHARS):
                for stretch, rows in _runs(part):
                    if seen and (stretch != held or len(seen) > STRETCH_WORDS):
                        yield found()
                        seen = set()
                    held = stretch
                    for text in set(rows.column("text").to_pylist()):
                        seen.update(split(text or ""))
        if seen:
            yield found()

    return docs.mapInArrow(run, "word string")


def _runs(batch: pa.RecordBatch):
    """(stretch, rows) of each run of rows of one stretch."""
    stretch = batch.column("stretch").to_numpy()
    change = (np.flatnonzero(stretch[1:] != stretch[:-1]) + 1).tolist()
    for at, end in zip([0, *change], [*change, batch.num_rows]):
        yield stretch[at].item(), batch.slice(at, end - at)


def shared_words(docs: DataFrame, ranks, pattern: str, text: str = "text") -> tuple[list[str], list[bytes]]:
    """The corpus' table: words of two or more stretches and their ids, at most ``MOST_SHARED``, the most widespread first.

    Words of the same class of counts (equal ones up to 64, ratios of 2 ** (1 / 8) above) come in or stay out together.
    """
    stretch = F.shiftright(F.monotonically_increasing_id(), STRETCH_ROWS.bit_length() - 1).alias("stretch")
    words = _words(docs.select(stretch, F.col(f"`{text}`").alias("text")), pattern)
    with Workspace(docs.sparkSession, "words") as space:
        counted = words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1")
        wide = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n") * 8) + 16).alias("wide")
        table = space.written(counted.select("word", wide), "shared")
        least, held = None, 0
        for row in sorted(table.groupBy("wide").count().collect(), reverse=True):  # some 300 classes at most
            held += row["count"]
            if held > MOST_SHARED:
                break
            least = row["wide"]
        if least is None:
            return [], []
        rows = _with_ids(table.where(F.col("wide") >= least).select("word"), ranks).collect()
    return [r["word"] for r in rows], [bytes(r["word_ids"]) for r in rows]


def _with_ids(words: DataFrame, ranks) -> DataFrame:
    """(word, word_ids): one replay over all words of a partition of the table."""

    def run(batches):
        rows = [b.column("word") for b in batches if b.num_rows]
        if rows:
            word = pa.chunked_array(rows)
            ids = replay(ranks.value, [w.encode("utf-8", "surrogatepass") for w in word.to_pylist()])
            yield pa.RecordBatch.from_arrays([pa.concat_arrays(word.chunks), pa.array(ids, pa.binary())], ["word", "word_ids"])

    return words.mapInArrow(run, "word string, word_ids binary")


def _apply(docs: DataFrame, path: str, pattern: str, new: str, fn, keep, text="text") -> DataFrame:
    context = docs.sparkSession.sparkContext
    ranks = context.broadcast(load(path, pattern))  # as large as the vocabulary
    table = context.broadcast(shared_words(docs, ranks, pattern, text))
    name = uuid.uuid4().hex
    return map_texts(docs, new, lambda: lambda values: fn(_encoder(name, ranks, table), values), keep=keep, max_chars=STEP_CHARS, text=text)


def encode(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """Append ``ids`` (array<int>) and ``n_tokens``."""

    def fn(enc, texts):
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in enc.encode(texts)]
        return ids, [len(x) for x in ids]

    return _apply(docs, path, pattern, "ids array<int>, n_tokens long", fn, keep)


def round_trip(docs: DataFrame, path: str, pattern: str, keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """Encode and decode again: n_tokens, ids_sha256, decoded_sha256, exact (the bytes are those of the text), and the ids if wanted."""

    def fn(enc, texts):
        out = []
        for t, ids in zip(texts, enc.encode(texts)):
            back = enc.decode(ids)
            row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back).hexdigest(), back == t.encode("utf-8", "surrogatepass"))
            out.append((*row, np.frombuffer(ids, "<i4")) if with_ids else row)
        return [list(c) for c in zip(*out)] if out else [[]] * (4 + with_ids)

    new = "n_tokens long, ids_sha256 string, decoded_sha256 string, exact boolean" + ", ids array<int>" * with_ids
    return _apply(docs, path, pattern, new, fn, keep)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """Append ``decoded`` (binary) to rows with ``ids``; null ids decode to no bytes."""
    ranks = encoded.sparkSession.sparkContext.broadcast(load(path, pattern))
    schema = encoded.drop("decoded").schema.add("decoded", "binary")

    def run(batches):
        tokens = ranks.value.tokens
        for b in batches:
            back = [b"".join(map(tokens.__getitem__, ids or [])) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(f.name) for f in schema.fields[:-1]] + [pa.array(back, pa.binary())], schema.names)

    return encoded.drop("decoded").mapInArrow(run, schema)
