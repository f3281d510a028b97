"""Secret scanning: fixed patterns plus a character convolutional network.

Base findings (code points, end exclusive) are the leftmost non-overlapping
matches of each pattern, without those that are too short.  Beside them, the
network scores every candidate -- a maximal run of the characters that an
assigned value may have, at least ``LEAST_RUN`` long, without dots at its ends --
together with the text around it.  Candidates within base findings lend them
their score; the others are added as kind ``net`` if they reach the threshold.
A run longer than ``INSIDE`` gets the highest score of the windows that slide
over it by ``STRIDE``.

The convolution runs once over the text, as tables of character pairs, and
serves all candidates: a window pools the kernels that lie wholly in it.

The network (numpy: embedding, one convolution, max and mean pooling, logistic
output) is trained on labelled findings of a bounded sample of documents:

* findings: windows that hold a base finding's value, and ``planted`` ones --
  such values cut, written in other alphabets, with or without another key name
  before them, in the middle of prose, where no fixed pattern finds them;
* others: the remaining runs, and ``decoys`` -- URLs, paths, names, dates, card,
  order and phone numbers, versions and UUIDs.

Its scores are calibrated by Platt scaling on a validation part, and the
threshold is the highest that keeps ``RECALL`` of the validation findings;
``recall`` and ``precision`` tell how it does on a third part.

Null and empty texts have no findings.  Without training findings of both
classes the network adds nothing, and base findings have no score.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import map_texts, thinned

#: Fixed patterns and least lengths, as the contract lists them.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "net")

LEAST_RUN = ASSIGN_LEAST
DIGIT = re.compile(r"[0-9]")
#: Characters of the run, and of the text on either side, that the network sees at a time; the step of its window over a longer run.
INSIDE, AROUND, STRIDE = 48, 24, 12
WIDTH = INSIDE + 2 * AROUND
EMBED, FILTERS, KERNEL = 8, 24, 5
RECALL = 0.97
#: Bound of the training sample: documents (by a hash of the id) and runs of each class.
MAX_TRAIN_DOCS, MAX_TRAIN_RUNS = 20_000, 5_000
EPOCHS = 10
#: Planted findings and decoys of one document.
PLANTED, DECOYS = 24, 3
#: Other runs of one document, of each kind, that may be among the examples.
PLAIN_RUNS = 16
#: Values from this length on are planted elsewhere, cut to no less.
LEAST_PLANTED = 20
#: Names before planted findings that the fixed patterns do not know, and alphabets that they are written in.
KEY_NAMES = ["", "", "", "pwd", "auth", "authorization bearer", "access key", "credential", "passphrase", "private key", "session", "signature", "x-auth"]
ALPHABETS = [
    "0123456789ABCDEF",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "abcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
]

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def values(text: str) -> list[tuple[int, int]]:
    """What is secret in the base findings: of an assignment its value."""
    found = [m.span(2) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    return found + [m.span() for p in (ACCESS, HEX) for m in p.finditer(text)]


def _code(c: str) -> int:
    """Classes: 0 nothing, 1-94 printable ASCII, 95 white space, 96 other letters, 97 the rest."""
    o = ord(c)
    return o - 32 if 33 <= o <= 126 else 95 if c.isspace() else 96 if c.isalpha() else 97


#: PAD fills up a window behind the text that it holds.
PAD, CODES = 98, 99
_IN_RUN = np.zeros(CODES, bool)
_IN_RUN[[_code(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"]] = True
_DOT = _code(".")


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    return np.fromiter((_code(chr(c)) for c in range(0x110000)), np.uint8, 0x110000)


def joined_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all texts with ``AROUND`` zeros before, between and after them, and where each text starts."""
    starts = AROUND + np.cumsum([0] + [len(t) + AROUND for t in texts])[:-1]
    gap = "\0" * AROUND
    points = np.frombuffer((gap + "".join(t + gap for t in texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = _codes()[points]
    for at, t in zip(starts, texts):
        codes[at + len(t) : at + len(t) + AROUND] = 0
    codes[:AROUND] = 0
    return codes, starts


def runs_of(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each candidate."""
    edge = np.diff(_IN_RUN[codes].astype(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    other = np.flatnonzero(codes != _DOT)  # dots at the ends do not belong to a run
    if len(other):
        start = other[np.minimum(np.searchsorted(other, start), len(other) - 1)]
        end = other[np.searchsorted(other, end) - 1] + 1
    else:
        end = start
    ok = end - start >= LEAST_RUN
    return start[ok], end[ok]


def windows_of(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the windows over each run, the last one at the run's end, and the run of each window."""
    n = 1 + np.maximum(0, -(-(end - start - INSIDE) // STRIDE))
    run = np.repeat(np.arange(len(start)), n)
    k = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    s = np.maximum(start[run], np.minimum(start[run] + k * STRIDE, end[run] - INSIDE))
    return s, np.minimum(s + INSIDE, end[run]), run


def cut_windows(codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """One row a window: the text before, the window, the text after, padding."""
    at = s[:, None] - AROUND + np.arange(WIDTH)
    out = codes[np.minimum(at, len(codes) - 1)]
    out[at >= e[:, None] + AROUND] = PAD
    return out


def candidates(text: str, digits: bool = True) -> list[tuple[int, int]]:
    """Start and end of the runs, on demand only of those with a digit."""
    codes, at = joined_codes([text])
    found = [(int(s - at[0]), int(e - at[0])) for s, e in zip(*runs_of(codes))]
    return [x for x in found if not digits or DIGIT.search(text, *x)]


def encode(text: str, start: int, end: int) -> list[int]:
    codes, at = joined_codes([text])
    return cut_windows(codes, at[:1] + start, at[:1] + min(end, start + INSIDE))[0].tolist()


_WEIGHTS = np.random.default_rng(11).integers(0, 2**64, WIDTH, np.uint64) | np.uint64(1)


@dataclass
class Net:
    embed: np.ndarray
    filters: np.ndarray  # (KERNEL * EMBED, FILTERS)
    bias: np.ndarray
    out: np.ndarray  # (2 * FILTERS,)
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    threshold: float = 1.0
    recall: float = 0.0
    precision: float = 0.0


def _windows(embedded: np.ndarray) -> np.ndarray:
    view = np.lib.stride_tricks.sliding_window_view(embedded, KERNEL, axis=1)  # n, positions, EMBED, KERNEL
    return view.reshape(*view.shape[:2], -1)


def _forward(net: Net, codes: np.ndarray):
    x = _windows(net.embed[codes])
    whole = codes[:, KERNEL - 1 :] != PAD
    z = np.maximum(x @ net.filters + net.bias, 0) * whole[..., None]
    top, n = z.argmax(1), whole.sum(1, keepdims=True).astype(np.float32)
    pooled = np.concatenate([z.max(1), z.sum(1) / n], 1)
    return x, z, top, n, pooled, pooled @ net.out + net.out_bias


def _probability(net: Net, logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(net.scale[0] * logit + net.scale[1], -30, 30)))


#: Windows that are convolved at a time; one takes some 50 kB meanwhile.
AT_A_TIME = 512


def _logits(net: Net, codes: np.ndarray) -> np.ndarray:
    return np.concatenate([_forward(net, codes[i : i + AT_A_TIME])[-1] for i in range(0, len(codes), AT_A_TIME)]) if len(codes) else np.zeros(0)


def score(net: Net, codes: np.ndarray) -> np.ndarray:
    """Calibrated probabilities."""
    return _probability(net, _logits(net, codes))


#: Positions that are convolved at a time, so that they stay in the cache.
STRETCH = 8192


def score_windows(net: Net, codes: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Calibrated probabilities of windows of joined codes, given by start; as ``score`` over ``cut_windows``."""
    f = net.filters.reshape(EMBED, KERNEL, FILTERS)
    one = [(net.embed @ f[:, k]).astype(np.float32) for k in range(KERNEL)]
    two = [(one[k][:, None] + one[k + 1]).reshape(-1, FILTERS) for k in (0, 2)]
    last = one[4] + net.bias
    logit = np.empty(len(s))
    cuts = np.flatnonzero(np.diff(s // STRETCH)) + 1
    for part in np.split(np.arange(len(s)), cuts) if len(s) else []:
        lo, hi = s[part[0]] - AROUND, e[part].max() + AROUND
        c = codes[lo:hi].astype(np.int32)
        pair = c[:-1] * CODES + c[1:]
        n = len(c) - KERNEL + 1
        z = two[0].take(pair[:n], 0)
        z += two[1].take(pair[2 : n + 2], 0)
        z += last.take(c[4:], 0)
        np.maximum(z, 0, out=z)
        total = np.zeros((n + 1, FILTERS))
        np.cumsum(z, 0, out=total[1:])
        for k in (1, 2, 4, 8, 16):  # the highest of 32 positions
            z = np.maximum(z[:-k], z[k:])
        l, r = s[part] - AROUND - lo, e[part] + AROUND - KERNEL + 1 - lo
        most = np.maximum(np.maximum(z[l], z[r - 32]), z[np.minimum(l + 32, r - 32)])
        logit[part] = most @ net.out[:FILTERS] + ((total[r] - total[l]) / (r - l)[:, None]) @ net.out[FILTERS:]
    return _probability(net, logit + net.out_bias)


def _platt(logit: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset by damped Newton steps on scaled logits, with smoothed targets."""
    t = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((y == 0).sum() + 2))
    unit = max(float(np.abs(logit).mean()), 1e-6)
    x, w = np.stack([logit / unit, np.ones_like(logit)], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t) + 0.1 * (w - np.array([1.0, 0.0])))
        w -= step / max(1.0, float(np.abs(step).max()))
    return (max(float(w[0]), 1e-3) / unit, float(w[1]))


def train(codes: np.ndarray, y: np.ndarray, seed: int = 7) -> Net | None:
    """Adam over shuffled batches; of every five examples one calibrates and one measures."""
    if len(set(y.tolist())) < 2 or min(y.sum(), (y == 0).sum()) < 10:
        return None
    r = np.random.default_rng(seed)
    small = lambda scale, *shape: r.normal(0, scale, shape).astype(np.float32)
    net = Net(small(0.3, CODES, EMBED), small(0.2, KERNEL * EMBED, FILTERS), np.zeros(FILTERS, np.float32), small(0.2, 2 * FILTERS), 0.0)
    val, last = np.arange(len(y)) % 5 == 0, np.arange(len(y)) % 5 == 1
    tc, ty = codes[~val & ~last], y[~val & ~last]
    weight = np.where(ty == 1, len(ty) / 2 / ty.sum(), len(ty) / 2 / (ty == 0).sum()).astype(np.float32)
    names = ("embed", "filters", "bias", "out")
    m, v, step = {k: 0.0 for k in names}, {k: 0.0 for k in names}, 0
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS)
        for at in np.array_split(r.permutation(len(ty)), max(1, len(ty) // 128)):
            c = tc[at].copy()
            hide = r.random(len(at)) < 0.3  # without the words around it now and then, so that the run itself counts
            c[hide, :AROUND] = 0
            x, z, top, n, pooled, logit = _forward(net, c)
            d = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - ty[at]) * weight[at] / len(at)
            gp = d[:, None] * net.out
            gz = np.repeat((gp[:, FILTERS:] / n)[:, None], z.shape[1], 1)
            np.put_along_axis(gz, top[:, None, :], np.take_along_axis(gz, top[:, None, :], 1) + gp[:, None, :FILTERS], 1)
            gz *= z > 0
            grad = {"out": pooled.T @ d, "bias": gz.sum((0, 1)), "filters": np.tensordot(x, gz, ([0, 1], [0, 1]))}
            gx = (gz @ net.filters.T).reshape(*gz.shape[:2], EMBED, KERNEL)
            ge = np.zeros((len(at), WIDTH, EMBED), np.float32)
            for k in range(KERNEL):
                ge[:, k : k + gx.shape[1]] += gx[..., k]
            grad["embed"] = np.stack([np.bincount(c.ravel(), ge[..., e].ravel(), minlength=CODES) for e in range(EMBED)], 1).astype(np.float32)
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                setattr(net, k, getattr(net, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
            net.out_bias -= 5 * rate * float(d.sum())
    logit = _logits(net, codes[val])
    net.scale = _platt(logit, y[val])
    got = _probability(net, logit)
    own = np.sort(got[y[val] == 1])
    net.threshold = float(own[int((1 - RECALL) * len(own))]) - 1e-6  # the order of sums may differ when texts are scanned
    above = score(net, codes[last]) >= net.threshold
    net.recall = float(above[y[last] == 1].mean()) if (y[last] == 1).any() else 0.0
    net.precision = float(y[last][above].mean()) if above.any() else 0.0
    return net


def planted(value: str, words: list[str], r: np.random.Generator) -> tuple[str, int, int]:
    """A text with a finding that no fixed pattern defines, made of a base finding's value, and its place."""
    secret = value[: int(r.integers(LEAST_PLANTED, len(value) + 1))]
    if r.random() < 0.8:
        letters = ALPHABETS[r.integers(len(ALPHABETS))]
        secret = "".join(letters[k] for k in r.integers(0, len(letters), len(secret)))
    if r.random() < 0.25:
        secret = "".join(chr(97 + k) for k in r.integers(0, 26, int(r.integers(2, 5)))) + "_-"[r.integers(2)] + secret
    name = KEY_NAMES[r.integers(len(KEY_NAMES))]
    before = " ".join([*_some(words, r, 6), name]).rstrip() + [" ", ": ", "=", " = \"", " '", "("][r.integers(6)]
    after = ["", "\"", "'", ",", ")", "."][r.integers(6)] + " " + " ".join(_some(words, r, 6))
    return before + secret + after, len(before), len(before) + len(secret)


def _some(words: list[str], r: np.random.Generator, n: int) -> list[str]:
    return [words[k] for k in r.integers(0, len(words), n)]


def decoy(words: list[str], r: np.random.Generator) -> tuple[str, int, int]:
    """A text with something long that is no secret, and its place."""
    w = [x.strip(".,;:!?()\"'") or "x" for x in _some(words, r, 4)]
    digits = lambda n: "".join(map(str, r.integers(0, 10, n)))
    hexes = lambda n: "".join("0123456789abcdef"[k] for k in r.integers(0, 16, n))
    kinds = (
        lambda: f"https://www.{w[0]}.com/{w[1]}/{w[2]}-{w[3]}?page={digits(2)}",
        lambda: f"/{w[0]}/{w[1]}/{w[2]}_{digits(3)}.txt",
        lambda: "_".join(w),
        lambda: "-".join(w[:3]),
        lambda: ".".join(w[:3]) + "@" + w[3] + ".org",
        lambda: "".join(x.capitalize() for x in w[:3]),
        lambda: w[0] + digits(int(r.integers(1, 5))),
        lambda: w[0].upper() + w[1].upper(),
        lambda: digits(int(r.integers(6, 21))),
        lambda: " ".join(digits(4) for _ in range(4)),
        lambda: f"{digits(4)}-{digits(2)}-{digits(2)}T{digits(2)}:{digits(2)}:{digits(2)}Z",
        lambda: f"{digits(3)}.{digits(3)}.{digits(2)}.{digits(3)}",
        lambda: f"ORD-{digits(4)}-{digits(6)}",
        lambda: f"v{digits(1)}.{digits(2)}.{digits(1)}-beta.{digits(1)}",
        lambda: f"+{digits(2)}-{digits(3)}-{digits(7)}",
        lambda: "-".join(hexes(n) for n in (8, 4, 4, 4, 12)),
    )
    made = kinds[r.integers(len(kinds))]()
    before = " ".join(_some(words, r, 6)) + " "
    return f"{before}{made} {' '.join(_some(words, r, 6))}", len(before), len(before) + len(made)


def _made(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Windows of planted findings and decoys of the texts, and which is which; the same for the same text."""
    snippets = []
    for t in texts:
        r = np.random.default_rng(xxhash.xxh3_64_intdigest(t.encode("utf-8", "surrogatepass")))
        words = t.split() or ["x"]  # surroundings are drawn from the whole text
        long = [t[a:b] for a, b in values(t) if b - a >= LEAST_PLANTED]
        drawn = r.permutation(len(long))  # of more values than are planted, as many by chance
        snippets += [(*planted(long[drawn[k % len(long)]], words, r), True) for k in range(PLANTED if long else 0)]
        snippets += [(*decoy(words, r), False) for _ in range(DECOYS)]
    codes, at = joined_codes([x[0] for x in snippets])
    s, e, _ = windows_of(*runs_of(codes))
    own = np.searchsorted(at, s, side="right") - 1
    a, b, secret = at[own] + np.array([x[1] for x in snippets])[own], at[own] + np.array([x[2] for x in snippets])[own], np.array([x[3] for x in snippets])[own]
    both = np.minimum(e, b) - np.maximum(s, a)
    ok = both >= np.where(secret, np.minimum(b - a, INSIDE // 2), 1)
    return cut_windows(codes, s[ok], e[ok]), secret[ok]


def fit(docs: DataFrame, id_col: str = "doc_id", max_docs: int = MAX_TRAIN_DOCS, max_runs: int = MAX_TRAIN_RUNS) -> Net | None:
    """Labelled findings of a sample of about ``max_docs`` documents.

    At most ``max_runs`` windows each of other runs without digits (0), with
    digits (1), of findings (2), runs near a finding (3), planted findings (4)
    and decoys (5), the first by a hash of what the network sees.  Of a text,
    ``PLAIN_RUNS`` windows of kinds 0 and 1 stand for all, and at most ``PLANTED``
    of its values are planted, drawn by a hash of the text; all else is offered
    whole, so the sample does not depend on how texts are dealt.
    """
    sample = thinned(docs.select(id_col, "text"), docs.select(id_col).count(), max_docs, id_col)

    def make():
        def fn(texts):
            codes, at = joined_codes(texts)
            s, e, _ = windows_of(*runs_of(codes))
            held = np.zeros(len(s), np.int64)  # 1: a finding; -1: no example
            near = np.zeros(len(s), bool)
            for i, t in enumerate(texts):
                for a, b in values(t):
                    a, b = at[i] + a, at[i] + b
                    own = slice(np.searchsorted(e, a - AROUND), np.searchsorted(s, b + AROUND))
                    both = np.minimum(e[own], b) - np.maximum(s[own], a)
                    held[own] = np.maximum(held[own], np.where(both >= min(b - a, INSIDE // 2), 1, np.where(both > 0, -1, 0)))
                    near[own] = True
                for a, b, _ in base_spans(t):
                    own = slice(np.searchsorted(e, at[i] + a, side="right"), np.searchsorted(s, at[i] + b))
                    held[own] = np.where(held[own] == 0, -1, held[own])
            digit = np.cumsum(np.concatenate([[0], (codes >= _code("0")) & (codes <= _code("9"))]))
            kind = np.where(held > 0, 2, np.where(near, 3, (digit[e] > digit[s]).astype(np.int64)))
            ok = held >= 0
            more, secret = _made(texts)
            rows = np.concatenate([cut_windows(codes, s[ok], e[ok]), more])
            kind = np.concatenate([kind[ok], np.where(secret, 4, 5)])
            h = (rows.astype(np.uint64) * _WEIGHTS).sum(1, dtype=np.uint64)
            h = ((h ^ (h >> np.uint64(29))) * _WEIGHTS[0]).view(np.int64)
            # of other runs there are plenty: of each text the first by hash, however texts are dealt
            text_of = np.concatenate([np.searchsorted(at, s[ok], side="right") - 1, np.full(len(more), -1)])
            plain = np.flatnonzero(kind <= 1)
            plain = plain[np.lexsort((h[plain], kind[plain], text_of[plain]))]
            group = text_of[plain] * 2 + kind[plain]
            begin = np.flatnonzero(np.diff(group, prepend=-1))
            place = np.arange(len(plain)) - np.repeat(begin, np.diff(np.append(begin, len(plain))))
            pick = [*plain[place < PLAIN_RUNS].tolist(), *np.flatnonzero(kind >= 2).tolist()]
            out = [{"y": int(kind[j]), "h": int(h[j]), "codes": rows[j].tobytes()} for j in pick]
            return [[out if i == 0 else [] for i in range(len(texts))]]

        return fn

    runs = map_texts(sample, "runs array<struct<y: int, h: long, codes: binary>>", make, keep=[], max_chars=250_000).select(F.explode("runs").alias("r")).select("r.*").distinct()
    runs = runs.persist()  # of a bounded sample
    try:
        first = [runs.where(F.col("y") == y).orderBy("h", "codes").limit(max_runs) for y in range(6)]
        got = reduce(DataFrame.union, first).collect()  # one query, so that the first of all partitions are picked before they are sent
    finally:
        runs.unpersist()
    codes = np.frombuffer(b"".join(r["codes"] for r in got), np.uint8).reshape(-1, WIDTH)
    y = np.array([r["y"] in (2, 4) for r in got], np.int64)
    order = np.argsort([hashlib.md5(bytes(r["codes"])).digest() for r in got], kind="stable") if got else []
    return train(codes[order], y[order]) if len(got) else None


def find_scored(net: Net | None, texts: list[str]) -> list[list[tuple[int, int, str, float | None]]]:
    """All spans of each text with the network's score, by start, then kind."""
    every: list[list] = [[(*s, None) for s in base_spans(t)] for t in texts]
    if net and texts:
        codes, at = joined_codes(texts)
        start, end = runs_of(codes)
        s, e, run = windows_of(start, end)
        top = np.zeros(len(start))
        np.maximum.at(top, run, score_windows(net, codes, s, e))
        covered = np.zeros(len(codes) + 1, np.int64)
        for i, spans in enumerate(every):
            for k, (a, b, kind, _) in enumerate(spans):
                covered[at[i] + a + 1 : at[i] + b + 1] = 1
                own = top[np.searchsorted(end, at[i] + a, side="right") : np.searchsorted(start, at[i] + b)]
                spans[k] = (a, b, kind, float(own.max()) if len(own) else None)
        covered = covered.cumsum()
        hits = np.flatnonzero((covered[start] == covered[end]) & (top >= net.threshold))
        for j, i in zip(hits.tolist(), (np.searchsorted(at, start[hits], side="right") - 1).tolist()):
            every[i].append((int(start[j] - at[i]), int(end[j] - at[i]), "net", float(top[j])))
    return [sorted(x, key=lambda s: (s[0], KINDS.index(s[2]))) for x in every]


def find(net: Net | None, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """For each text its base spans and all spans, by start, then kind."""
    return [([s[:3] for s in x if s[2] != "net"], [s[:3] for s in x]) for x in find_scored(net, texts)]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def scan(docs: DataFrame, net: Net | None, keep: list[str] | None = None) -> DataFrame:
    """Append ``findings`` (array of start, end, kind, score) of each text, base ones marked; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few thousand weights

    def make():
        def fn(texts):
            return [[[{"start": s, "end": e, "kind": k, "base": k != "net", "score": p} for s, e, k, p in every] for every in find_scored(shared.value, texts)]]

        return fn

    return map_texts(docs, "findings array<struct<start: int, end: int, kind: string, base: boolean, score: double>>", make, keep=keep)


def redact(docs: DataFrame, net: Net | None) -> DataFrame:
    """The documents with every found span replaced by ``[kind]``; overlapping spans become one, named by the first."""
    shared = docs.sparkSession.sparkContext.broadcast(net)
    order = docs.columns

    def cut(text: str, spans: list[Span]) -> str:
        out, at = [], 0
        for s, e, k in spans:
            if s >= at:
                out.append(text[at:s] + f"[{k}]")
            at = max(at, e)
        return "".join([*out, text[at:]])

    def make():
        return lambda texts: [[cut(t, every) for t, (_, every) in zip(texts, find(shared.value, texts))]]

    made = map_texts(docs, "`_redacted` string", make)
    return made.withColumn("text", F.when(F.col("text").isNotNull(), F.col("_redacted"))).select(*order)
