"""Toxicity by a weighted finite-state pattern grammar.

The words of a clause become symbols -- INSULT and THREAT (weighted), TARGET,
NEGATION, REPORT, OTHER -- that a composition of transducers reads:

* ``hit``: chooses one insult or threat of the clause and marks it, in all ways;
* ``negation``: a mark within ``NEGATION_SPAN`` symbols of a negation counts less;
* ``reported``: a mark behind a reporting word counts less;
* ``pattern``: accepts the clause with the weight of what it holds: target and
  insult, threat and target, or one of them alone.

A transducer's arcs carry weights; ``compose`` joins what one writes to what the
next one reads and multiplies the weights.  A clause's score is the summed
weight of all accepting paths of the composition, hence that of all its marks;
clauses without an insult or threat have none and are never looked at further.
A document's score is a logistic function of its matched clauses.  Its
coefficients and the weights of target, threat, negation and report are learnt
together on labelled documents.

The insult stems are learnt from a bounded sample of labelled documents that
are not held out: words and word prefixes that occur in toxic documents nearly
alone.  No label, language, source or id enters a score.  Null and empty texts
have no clause and get the score of a document without matches.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict
from dataclasses import dataclass, fields, replace
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import labelled, map_texts, texts_of

#: Closed-class words of the grammar.
#: Stems of threats, each with the endings that make a word of it.
THREAT_STEMS = {
    "kill murder destroy hurt stab stabb shoot": " s ed ing er ers",
    "töt umbring": "e en est et t end te ten",
    "tu assassin": "er é ée és ées erai eras era erons erez eront ez ant",
    "mat asesin": "ar o as a an amos ado ada aré arás ará aremos arán ando",
}
THREATS = sorted({stem + end for stems, ends in THREAT_STEMS.items() for stem in stems.split() for end in ends.split(" ")} - {"tué", "mat"} | {"tué", "umgebracht", "shot"})
TARGETS = "you your yours he she they him her them these those this that du ihr sie dich tu vous toi il elle tú usted ustedes él ella".split()
NEGATIONS = "not never no nor isn't aren't don't nicht kein keine nie niemals ne pas jamais nunca jamás".split()
REPORTS = "said says saying called quote quoted wrote claims claimed sagte sagt schrieb dit disait écrit dijo dice escribió".split()

THREAT_WEIGHT = 1.0
NEGATION_SPAN = 3
#: What the transducers weigh before anything is learnt, and where the labels say nothing.
NEGATED, REPORTED = 0.5, 0.7
PATTERNS = {("INSULT", True): 1.2, ("INSULT", False): 1.0, ("THREAT", True): 1.2, ("THREAT", False): 0.8}


@dataclass(frozen=True)
class Weights:
    """The weights that are learnt: of a mark in reach of a negation or report, and of a clause by what it holds."""

    negated: float = NEGATED
    reported: float = REPORTED
    insult: float = PATTERNS["INSULT", False]
    insult_target: float = PATTERNS["INSULT", True]
    threat: float = PATTERNS["THREAT", False]
    threat_target: float = PATTERNS["THREAT", True]


#: Factors that a step of learning tries, the pull back to the first weights, and rounds over all of them.
FACTORS, PULL, ROUNDS = (0.25, 0.5, 0.8, 1.25, 2.0), 3.0, 3
SYMBOLS = ("INSULT", "THREAT", "TARGET", "NEGATION", "REPORT", "OTHER")
MARKS = {"INSULT": "*INSULT", "THREAT": "*THREAT"}
#: Bound of the labelled sample, by a hash of the id.
MAX_TRAIN_DOCS = 8_000
MIN_TOXIC, MIN_PRECISION = 8, 0.9
#: Toxic documents with a stem in each half of the sample.
MIN_HALF = 2
STEM = (4, 10)
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
CLAUSE_END = re.compile(r"[.,;:!?\n|]")


@dataclass
class Transducer:
    """Weighted arcs {(state, symbol read): [(state, symbol written, weight)]}, a start and the weights of final states."""

    start: object
    arcs: dict[tuple, list[tuple]]
    final: dict[object, float]

    def weight(self, symbols: list[tuple[str, float]]) -> float:
        """The summed weight of all accepting paths over (symbol, its own weight if it is marked)."""
        at = {self.start: 1.0}
        for symbol, own in symbols:
            to: dict = defaultdict(float)
            for state, w in at.items():
                for end, written, arc in self.arcs.get((state, symbol), ()):
                    to[end] += w * arc * (own if written.startswith("*") and not symbol.startswith("*") else 1.0)
            at = to
        return sum(w * self.final.get(state, 0.0) for state, w in at.items())


def compose(a: Transducer, b: Transducer) -> Transducer:
    """Reads what ``a`` reads, writes what ``b`` writes of what ``a`` writes; only states that can be reached."""
    reads = defaultdict(list)
    for (state, symbol), arcs in a.arcs.items():
        reads[state].append((symbol, arcs))
    start = (a.start, b.start)
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol, own in reads[state[0]]:
            made = [((x, y), written, v * w) for x, middle, v in own for y, written, w in b.arcs.get((state[1], middle), ())]
            if made:
                arcs[state, symbol] = made
            for end, _, _ in made:
                if end not in seen:
                    seen.add(end)
                    todo.append(end)
    return Transducer(start, arcs, {s: a.final[s[0]] * b.final[s[1]] for s in seen if s[0] in a.final and s[1] in b.final})


def hit() -> Transducer:
    arcs = {(state, x): [(state, x, 1.0)] for state in ("before", "after") for x in SYMBOLS}
    for x, mark in MARKS.items():
        arcs["before", x].append(("after", mark, 1.0))
    return Transducer("before", arcs, {"after": 1.0})


def negation(weights: Weights = Weights()) -> Transducer:
    arcs = {}
    for left in range(NEGATION_SPAN + 1):
        for x in (*SYMBOLS, *MARKS.values()):
            to = NEGATION_SPAN if x == "NEGATION" else max(0, left - 1)
            arcs[left, x] = [(to, x, weights.negated if left and x in MARKS.values() else 1.0)]
    return Transducer(0, arcs, dict.fromkeys(range(NEGATION_SPAN + 1), 1.0))


def reported(weights: Weights = Weights()) -> Transducer:
    arcs = {}
    for said in (False, True):
        for x in (*SYMBOLS, *MARKS.values()):
            arcs[said, x] = [(said or x == "REPORT", x, weights.reported if said and x in MARKS.values() else 1.0)]
    return Transducer(False, arcs, {False: 1.0, True: 1.0})


def pattern(weights: Weights = Weights()) -> Transducer:
    kinds = {mark: kind for kind, mark in MARKS.items()}
    arcs = {}
    for kind in (None, *kinds.values()):
        for target in (False, True):
            for x in (*SYMBOLS, *kinds):
                if kind is None or x not in kinds:
                    arcs[(kind, target), x] = [((kinds.get(x, kind), target or x == "TARGET"), x, 1.0)]
    final = {(kind, target): getattr(weights, kind.lower() + "_target" * target) for kind in kinds.values() for target in (False, True)}
    return Transducer((None, False), arcs, final)


@lru_cache(512)
def composed(weights: Weights = Weights()) -> Transducer:
    return compose(compose(compose(hit(), negation(weights)), reported(weights)), pattern(weights))


@dataclass
class Grammar:
    stems: dict[str, float]
    coef: tuple[float, ...] = (0.0, 0.0, 0.0)
    weights: Weights = Weights()

    def __post_init__(self):
        self.closed = dict.fromkeys(TARGETS, "TARGET") | dict.fromkeys(NEGATIONS, "NEGATION") | dict.fromkeys(REPORTS, "REPORT") | dict.fromkeys(THREATS, "THREAT")
        self.scan = ahocorasick.Automaton()
        for w in [*self.stems, *THREATS]:
            self.scan.add_word(w, len(w))
        self.scan.make_automaton()

    def __getstate__(self):
        return {"stems": self.stems, "coef": self.coef, "weights": self.weights}

    def __setstate__(self, state):
        self.__init__(**state)

    def symbol(self, word: str) -> tuple[str, float]:
        kind = self.closed.get(word)
        if kind:
            return kind, THREAT_WEIGHT if kind == "THREAT" else 0.0
        for n in range(min(len(word), STEM[1]), STEM[0] - 1, -1):
            w = self.stems.get(word[:n])
            if w:
                return "INSULT", w
        return "OTHER", 0.0

    def clause_score(self, clause: str) -> float:
        """The weight that the composed transducers give to a lower-cased clause."""
        return composed(self.weights).weight(self.symbols(clause))

    def symbols(self, clause: str) -> list[tuple[str, float]]:
        return [self.symbol(w) for w in WORD.findall(clause)]

    def clauses(self, text: str) -> list[tuple[int, int, float]]:
        """(start, end, score) of the clauses with a match, in code points of the text."""
        low = text.lower()
        if len(low) != len(text):  # a letter whose lower case is two stays, so that places are those of the text
            low = "".join(x if len(x := c.lower()) == 1 else c for c in text)
        hits = [(end - n + 1) for end, n in self.scan.iter(low)]
        hits = [a for a in hits if not (a and low[a - 1].isalpha())]
        if not hits:
            return []
        cuts = [m.start() for m in CLAUSE_END.finditer(low)]
        out, done = [], -1
        for start in sorted(hits):
            if start < done:
                continue
            k = bisect_right(cuts, start)
            left = cuts[k - 1] + 1 if k else 0
            k = bisect_left(cuts, start)
            done = cuts[k] if k < len(cuts) else len(low)
            s = self.clause_score(low[left:done])
            if s > 0:
                out.append((left, done, s))
        return out

    def score(self, text: str) -> float:
        return self.rating([s for *_, s in self.clauses(text)])

    def rating(self, found: list[float]) -> float:
        """The score of a text from those of its clauses."""
        z = sum(a * b for a, b in zip(self.coef, features(found)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features(found: list[float]) -> list[float]:
    return [1.0, math.log1p(sum(found)), max(found, default=0.0)]


def _prefixes(text: str) -> set[str]:
    return {w[:n] for w in set(WORD.findall(text.lower())) for n in range(STEM[0], min(len(w), STEM[1]) + 1)}


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (p - y) + 0.05 * w)
        w -= step / max(1.0, float(np.abs(step).max()))
    return tuple(map(float, w))


def learnt(examples: list[tuple[int, list]], weights: Weights = Weights()) -> tuple[Weights, tuple[float, ...]]:
    """Weights of the transducers, and the logistic function over them, that make the labels likeliest.

    ``examples`` are (label, symbols of each matched clause).  One weight at a
    time is tried at a few factors; the pull towards the first weights keeps
    those for which the labels say nothing.
    """
    y = np.array([label for label, _ in examples], float)

    def fitted(w: Weights) -> tuple[float, tuple[float, ...]]:
        machine = composed(w)
        x = np.array([features([machine.weight(c) for c in clauses]) for _, clauses in examples])
        coef = _logistic(x, y)
        z = np.clip(x @ np.array(coef), -30, 30)
        pull = sum(math.log(getattr(w, f.name) / f.default) ** 2 for f in fields(Weights))
        return float((y * z - np.logaddexp(0, z)).sum()) - PULL * pull, coef

    best, coef = fitted(weights)
    for _ in range(ROUNDS):
        before = best
        for f in fields(Weights):
            for factor in FACTORS:
                other = replace(weights, **{f.name: getattr(weights, f.name) * factor})
                got, c = fitted(other)
                if got > best + 1e-6:
                    best, coef, weights = got, c, other
        if best - before < 1e-3:
            break
    return weights, coef


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Grammar:
    """Stems, weights of the transducers and the logistic function, from at most ``max_docs`` labelled documents.

    A stem has to hold in both halves of the sample, dealt by a hash of the text.
    """
    sample = labelled(docs, labels, "toxic", max_docs).persist()
    try:
        size = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
        if not size.get(1):
            return Grammar({}, (-4.0, 0.0, 0.0))

        def count(batches):
            seen = (Counter(), Counter())
            half = Counter()  # toxic texts of the first half
            for b in batches:
                for t, y in zip(texts_of(b), b.column("y").to_pylist()):
                    own = _prefixes(t)
                    seen[y].update(own)
                    if y and zlib.crc32(t.encode("utf-8", "surrogatepass")) % 2:
                        half.update(own)
            words = [w for w in seen[1]] + [w for w in seen[0] if w not in seen[1]]
            for i in range(0, len(words), 50_000):
                part = words[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), *[pa.array([c[w] for w in part], pa.int64()) for c in (seen[1], seen[0], half)]], ["stem", "toxic", "clean", "half"])

        # as if both classes had as many documents
        ratio = size.get(0, 0) / size[1] if size.get(0) else 1.0
        stems = (
            sample.mapInArrow(count, "stem string, toxic long, clean long, half long")
            .groupBy("stem")
            .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.sum("half").alias("half"))
            .where((F.col("toxic") >= F.lit(MIN_TOXIC)) & (F.col("toxic") * ratio >= MIN_PRECISION * (F.col("toxic") * ratio + F.col("clean"))) & (F.col("clean") <= 0.1 * F.col("toxic")))
            .where(F.col("half").between(MIN_HALF, F.col("toxic") - MIN_HALF))
            .collect()
        )  # from a bounded sample, MIN_TOXIC documents each
        by = {r["stem"]: r for r in stems}
        for w in sorted(by, key=len):
            longer = [x for x in by if x != w and x.startswith(w)]
            if any(by[x]["toxic"] >= 0.98 * by[w]["toxic"] for x in longer):
                del by[w]  # a longer stem says the same
        for w in sorted(by, key=len, reverse=True):
            if any(w[:n] in by for n in range(STEM[0], len(w))):
                del by[w]  # a shorter stem says more
        grammar = Grammar({w: math.log((r["toxic"] + 1) * ratio / (r["clean"] + 1)) for w, r in by.items()})

        def matched(texts):
            return [[[[{"s": s, "w": w} for s, w in grammar.symbols(t[a:b].lower())] for a, b, _ in grammar.clauses(t)] for t in texts]]

        x = map_texts(sample, "c array<array<struct<s: string, w: double>>>", lambda: matched, keep=["y"]).collect()
        examples = [(r["y"], [[tuple(s) for s in c] for c in r["c"]]) for r in x]
        weights, coef = learnt(examples)
        return Grammar(grammar.stems, coef, weights)
    finally:
        sample.unpersist()


def detect(docs: DataFrame, grammar: Grammar, keep: list[str] | None = None) -> DataFrame:
    """Append ``score`` (0 to 1) and ``clauses`` (start, end, score of each matched clause)."""
    shared = docs.sparkSession.sparkContext.broadcast(grammar)  # bounded: stems of a bounded sample

    def make():
        g = shared.value

        def fn(texts):
            found = [g.clauses(t) for t in texts]
            return [[g.rating([s for *_, s in c]) for c in found], [[{"start": a, "end": b, "score": s} for a, b, s in c] for c in found]]

        return fn

    return map_texts(docs, "score double, clauses array<struct<start: int, end: int, score: double>>", make, keep=keep)
