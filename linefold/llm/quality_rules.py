"""Quality rules as a short-circuit cascade, with DataFrame functions only.

A rule says of a text whether it fails.  ``profile`` measures on a sample how
long each rule takes and which texts it rejects; ``ordered`` puts first the
rule that rejects most for its cost among what the rules before it leave; and
``cascade`` asks the rules in that order as one CASE expression, so that a text
is not measured any further once a rule has rejected it.  The verdict does not
depend on the order; the name of the rule that gave it does.

Words are separated by space and the characters 9 to 13.  A null or empty text
has no words and fails ``few_words``.  Each row is judged for itself, in place,
without a shuffle: repeated rows get the same verdict, a long text is one row
whose arrays grow with its words, and columns beside the text are passed on.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import thinned
from linefold.session import Workspace

#: Separators of words, symbols, length of a window of words.
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Rows on which cost and selectivity are estimated.
SAMPLE_ROWS = 2_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def whole(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def words(text: Column) -> Column:
    return F.array_remove(F.split(whole(text), GAP, -1), "")


def lines(text: Column) -> Column:
    """The lines that hold a word."""
    return F.filter(F.split(whole(text), "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def length_without(text: Column, gone: str) -> Column:
    return F.length(F.translate(whole(text), gone, "")).cast("long")


def occurrences(text: Column, pattern: str) -> Column:
    """Code points that match a pattern of one character."""
    return (F.length(whole(text)) - F.length(F.regexp_replace(whole(text), f"(?:{pattern})+", ""))).cast("long")


def repeated_words(w: Column) -> Column:
    """Words inside a window of ``WINDOW`` words that the array holds twice or more.

    Windows are hashed; only if two hashes are equal are they sorted, neighbours
    compared word for word, and the lengths of what they cover added.
    """
    starts = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, WINDOW)))

    def same(a: Column, b: Column) -> Column:
        return F.coalesce((a["h"] == b["h"]) & (F.slice(w, a["i"] + 1, WINDOW) == F.slice(w, b["i"] + 1, WINDOW)), F.lit(False))

    def covered(at: Column) -> Column:
        lengths = F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW))))
        return F.aggregate(lengths, F.lit(0), lambda a, x: a + x)

    def found(h: Column) -> Column:
        by_hash = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            return F.sort_array(F.transform(F.filter(s, lambda x, k: same(x, F.get(s, k + 1)) | same(x, F.get(s, k - 1))), lambda x: x["i"]))

        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(let(let(by_hash, twice), covered))

    return F.when(F.size(w) <= WINDOW, 0).otherwise(let(hashes, found)).cast("long")


#: What the rules read of a text, each an expression of the text alone.
MEASURES: dict[str, Callable[[Column], Column]] = {
    "n_words": lambda t: F.size(words(t)).cast("long"),
    "word_chars": lambda t: length_without(t, BLANKS),
    "n_symbols": lambda t: (F.length(whole(t)) - length_without(t, SYMBOLS)).cast("long"),
    "n_lines": lambda t: F.size(lines(t)).cast("long"),
    "n_dup_lines": lambda t: let(lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    "n_repeat_words": lambda t: let(words(t), repeated_words),
    "n_shouts": lambda t: (F.length(whole(t)) - length_without(t, "!?")).cast("long"),
    "n_letters": lambda t: occurrences(t, r"\p{L}"),
    "n_capitals": lambda t: occurrences(t, r"\p{Lu}"),
    "n_digits": lambda t: occurrences(t, "[0-9]"),
    "n_long_runs": lambda t: F.size(F.regexp_extract_all(whole(t), F.lit(r"([^\x20\x09-\x0D]{200,})"), F.lit(0))).cast("long"),
}


class Measures:
    """The measures of a row: columns it already has, else expressions of its text."""

    def __init__(self, text: str = "text", have: tuple[str, ...] = ()):
        self._text, self._have = text, have

    def __getattr__(self, name: str) -> Column:
        return F.col(name) if name in self._have else MEASURES[name](F.col(f"`{self._text}`"))


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the measures of a row to true where the row is rejected; it is never null."""

    name: str
    fails: Callable[[Measures], Column]


#: The two rules that every use has to apply.
BASE = [
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
]
#: Further rules.  The limits are wide: prose in any script passes them.
FURTHER = [
    Rule("symbols", lambda m: 100 * m.n_symbols > 30 * m.n_words),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 30 * m.n_lines),
    Rule("shouting", lambda m: 100 * m.n_shouts > 50 * m.n_words),
    Rule("capitals", lambda m: 100 * m.n_capitals > 70 * m.n_letters),
    Rule("digits", lambda m: 100 * m.n_digits > 50 * m.word_chars),
    Rule("no_letters", lambda m: 100 * m.n_letters < 30 * m.word_chars),
    Rule("long_runs", lambda m: 10 * m.n_long_runs > m.n_words),
]


def measured(docs: DataFrame, names: list[str], text: str = "text") -> DataFrame:
    """Append measures as columns.  What is counted over the words shares one array of them."""
    of_words = {
        "n_words": lambda w: F.size(w).cast("long"),
        "n_repeat_words": repeated_words,
    }
    both = [n for n in names if n in of_words]
    pack = let(words(F.col(f"`{text}`")), lambda w: F.struct(*[of_words[n](w).alias(n) for n in both])) if both else None
    out = docs.drop(*names)
    if both:
        out = out.withColumn("_of_words", pack)
    cols = [F.col(f"_of_words.{n}").alias(n) if n in both else MEASURES[n](F.col(f"`{text}`")).alias(n) for n in names]
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c != "_of_words"], *cols)


@dataclass(frozen=True)
class Profile:
    """Seconds a rule took on the sample, and how many sample rows fail exactly each set of rules."""

    seconds: dict[str, float]
    patterns: dict[tuple[bool, ...], int]


def profile(docs: DataFrame, rules: list[Rule], measures: Measures, sample_rows: int = SAMPLE_ROWS, key: str = "doc_id", text: str = "text") -> Profile:
    """Cost and selectivity of the rules on about ``sample_rows`` rows, drawn by a hash of key and text.

    The sample is a table; each rule is one small aggregate over it, run twice
    and timed, less the time of an aggregate that only reads the texts.
    """
    spark = docs.sparkSession
    with Workspace(spark, "rules") as work:
        sample = work.written(thinned(docs, docs.count(), sample_rows, key, text), "sample")

        def seconds(flag: Column) -> float:
            took = []
            for _ in range(2):
                began = time.perf_counter()
                sample.agg(F.count_if(flag)).collect()
                took.append(time.perf_counter() - began)
            return min(took)

        idle = seconds(F.length(f"`{text}`") > 0)
        cost = {r.name: max(seconds(r.fails(measures)) - idle, 1e-4) for r in rules}
        flags = [r.fails(measures).alias(f"_{i}") for i, r in enumerate(rules)]
        seen = sample.select(*flags).groupBy(*[f"_{i}" for i in range(len(rules))]).count().collect()  # one row a set of rules
        return Profile(cost, {tuple(row[:-1]): row[-1] for row in seen})


def ordered(rules: list[Rule], known: Profile) -> list[Rule]:
    """By rejections per cost among the sample rows that the rules before leave; of equals the cheaper, then as listed."""
    left, out = dict(enumerate(rules)), []
    patterns = dict(known.patterns)
    while left:
        best = max(left, key=lambda i: (sum(n for p, n in patterns.items() if p[i]) / known.seconds[rules[i].name], -known.seconds[rules[i].name], -i))
        out.append(left.pop(best))
        patterns = {p: n for p, n in patterns.items() if not p[best]}
    return out


def cascade(docs: DataFrame, rules: list[Rule], measures: Measures) -> DataFrame:
    """Append failed_rule (the first that rejects, in the order given; else null) and kept."""
    verdict = F.lit(None).cast("string")
    for r in reversed(rules):
        verdict = F.when(r.fails(measures), r.name).otherwise(verdict)
    out = docs.drop("failed_rule", "kept").withColumn("failed_rule", verdict)
    return out.withColumn("kept", F.col("failed_rule").isNull())


def screen(docs: DataFrame, rules: list[Rule] | None = None, text: str = "text", key: str = "doc_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The cascade over texts, its order learnt on a sample of them."""
    rules, m = rules or [*BASE, *FURTHER], Measures(text)
    return cascade(docs, ordered(rules, profile(docs, rules, m, sample_rows, key, text)), m)
