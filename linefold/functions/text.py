"""Column functions with the text rules of the engine: Unicode blanks, code points, first match wins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as a character class that Java and RE2 read alike.
BLANK = r"[\t-\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(c) -> Column:
    return F.regexp_replace(c, f"^{BLANK}+|{BLANK}+$", "")


def first_text(*cols) -> Column:
    """The first non-empty value, stripped; empty if there is none."""
    return strip(F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols], F.lit("")))


def first_truthy(*cols) -> Column:
    """The first value that is neither null nor 0."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(0.0)) for c in cols])


def mask_digits(c) -> Column:
    return F.regexp_replace(c, r"(?U)\d+", "#")


def keep_only(c, run: str) -> Column:
    """The runs that match ``run``, joined."""
    return F.array_join(F.regexp_extract_all(c, F.lit(f"({run})"), F.lit(1)), "")


def grams(c, n: int = 3) -> Column:
    """Distinct n-character shingles; a shorter text is one, an empty one has none.

    A look-ahead yields the shingle at every position in one pass; cutting each
    out with substring would walk the text from its start every time.  It moves
    by UTF-16 units, so texts beyond the basic plane take their characters apart
    and zip them instead.
    """
    c = F.col(c) if isinstance(c, str) else c
    ahead = F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    chars = F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))
    zipped = F.arrays_zip(*[F.slice(chars, k + 1, F.greatest(F.length(c), F.lit(1))).alias(f"c{k}") for k in range(n)])
    whole = F.filter(zipped, lambda x: x[f"c{n - 1}"].isNotNull())
    apart = F.transform(whole, lambda x: F.concat(*[x[f"c{k}"] for k in range(n)]))
    size = F.coalesce(F.length(c), F.lit(0))
    many = F.array_distinct(F.when(c.rlike(r"[\x{10000}-\x{10FFFF}]"), apart).otherwise(ahead))
    return F.when(size == 0, F.array().cast("array<string>")).when(size <= n, F.array(c)).otherwise(many)


def match_marker(c, table: list[tuple[str, str, str]]) -> Column:
    """struct(name, raw, kind) of the first pattern of (name, pattern, kind) that the text begins with; null if none.

    The pattern's first group, if any, is ``raw``.
    """
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for name, pattern, kind in table:
        raw = F.regexp_extract(c, pattern, 1 if "(" in pattern.replace("(?", "").replace(r"\(", "") else 0)
        hit = F.struct(F.lit(name).alias("name"), raw.alias("raw"), F.lit(kind).alias("kind"))
        out = F.when(c.rlike(pattern), hit) if out is None else out.when(c.rlike(pattern), hit)
    return out


def strip_marker(c, table: list[tuple[str, str, str]]) -> Column:
    """The text without what the first matching pattern covers."""
    c = F.col(c) if isinstance(c, str) else c
    out = None
    for _, pattern, _ in table:
        rest = F.regexp_replace(c, pattern, "")
        out = F.when(c.rlike(pattern), rest) if out is None else out.when(c.rlike(pattern), rest)
    return out.otherwise(c)


def scrub(c, steps: list[tuple[str, str]]) -> Column:
    """Replacements in order."""
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    return c


def ordered_concat(order: list, text, sep: str = "") -> Column:
    """Aggregate: the texts of a group joined in the given order."""
    rows = F.sort_array(F.collect_list(F.struct(*[F.col(o).alias(f"k{i}") if isinstance(o, str) else o.alias(f"k{i}") for i, o in enumerate(order)], (F.col(text) if isinstance(text, str) else text).alias("t"))))
    return F.array_join(F.transform(rows, lambda x: x["t"]), sep)


def upper_median(value: str) -> Column:
    """Aggregate: of an even number of values the upper middle one."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")


def occurrences(c, word: str) -> Column:
    """How often ``word`` occurs, without overlaps."""
    c = F.col(c) if isinstance(c, str) else c
    return F.size(F.split(c, F.lit(r"\Q" + word + r"\E"), -1)) - 1
