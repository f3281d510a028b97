"""Widening a problem over its neighbouring blocks, on an injected judge's word.

A block is a stretch of lines that a wide gap separates from the next.  Of an
open problem the nearest blocks on either side are shown to the judge together
with the problem, numbered, and the judge names those that belong together.
Lines of a problem that was widened belong to it from then on, so problems are
worked on in order, one file at a time; files are dealt over the cluster.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linefold.operators.folds import by_group

MOST_BLOCKS, SHOWN = 2, 400
# Heads of blocks that are never part of a problem, and of lines that are pictures.
SOLUTION_HEAD = re.compile(r"^\s*(풀이|증명|답)\b")
PICTURE = "!["
ANCHOR = "★"


def neighbours(wide: Sequence, closed: Sequence, at: int, step: int, most: int = MOST_BLOCKS) -> list[tuple[int, int]]:
    """The nearest blocks (first, last) from line ``at`` on in direction ``step``, up to a closed line.

    ``wide[i]`` says whether the gap before line i is wide.  Nothing beyond these blocks is looked at.
    """
    parts: list[tuple[int, int]] = []
    begin = end = at
    while 0 <= end < len(closed) and not closed[end] and len(parts) < most:
        after = end + step
        # the later of two neighbouring lines has the gap between them
        if not 0 <= after < len(closed) or closed[after] or wide[max(end, after)]:
            parts.append((min(begin, end), max(begin, end)))
            begin = after
        end = after
    return parts


def shown(texts: list[str], block: tuple[int, int]) -> str:
    out = ""
    for t in texts[block[0] : block[1] + 1]:
        if t and not t.startswith(PICTURE):
            out += " " * bool(out) + t
            if len(out) >= SHOWN:
                break
    return out[:SHOWN]


def together(answer: str, anchor: int, n: int) -> tuple[int, int]:
    """First and last of the unbroken numbers around the anchor that an answer names; the anchor alone if it is not named."""
    named = {int(x) for x in re.findall(r"\d+", answer)} & set(range(1, n + 1))
    lo = hi = anchor
    if anchor in named:
        while lo - 1 in named:
            lo -= 1
        while hi + 1 in named:
            hi += 1
    return lo, hi


def refine_file(lines: pd.DataFrame, problems: pd.DataFrame, ask: Callable[[str], str], least_gap: float) -> list[tuple]:
    """(start, first, last, status) of each problem; places are those of ``idx``."""
    lines, problems = lines.sort_values("idx"), problems.sort_values("start")
    gap = lines["gap"].to_numpy(dtype=float, na_value=np.nan).tolist()
    return _refined(lines["idx"].tolist(), lines["text"].tolist(), gap, lines["head"].fillna(False).tolist(), list(zip(problems["start"], problems["end"], problems["open"])), ask, least_gap)


def _refined(idx: list, texts: list, gap: list, head: list, problems: list[tuple], ask: Callable[[str], str], least_gap: float) -> list[tuple]:
    """As ``refine_file``, of lines and problems in order."""
    texts = [t or "" for t in texts]
    wide = [g is not None and g > least_gap for g in gap]
    closed = [bool(h) for h in head]
    spans = [(bisect_left(idx, a), bisect_left(idx, b)) for a, b, _ in problems]
    for a, b in spans:
        closed[a : b + 1] = [True] * len(closed[a : b + 1])
    out = []
    for (a, b), (start, _, is_open) in zip(spans, problems):
        first, last, status = a, b, "as it is"
        if is_open:
            usable = lambda x: (t := shown(texts, x)) and not SOLUTION_HEAD.match(t)
            before = [x for x in neighbours(wide, closed, a - 1, -1) if usable(x)]
            after = [x for x in neighbours(wide, closed, b + 1, 1) if usable(x)]
            if before or after:
                order = [*reversed(before), (a, b), *after]
                anchor = len(before) + 1
                text = "\n\n".join(f"[{k}]{' ' + ANCHOR if k == anchor else ''} {shown(texts, x)}" for k, x in enumerate(order, 1))
                try:
                    lo, hi = together(ask(text), anchor, len(order))
                    status = "widened" if (lo, hi) != (anchor, anchor) else "asked"
                    first, last = order[lo - 1][0], order[hi - 1][1]
                    closed[first : last + 1] = [True] * (last + 1 - first)
                except Exception:  # noqa: BLE001  a judge that fails leaves the problem as it is
                    status = "failed"
        out.append((int(start), int(idx[first]), int(idx[last]), status))
    return out


def refine(lines: DataFrame, problems: DataFrame, file: str, ask: Callable[[str], str], least_gap: float) -> DataFrame:
    """(file, start, first, last, status): lines has (file, idx, text, gap, head), problems (file, start, end, open)."""
    kind = lines.schema[file].dataType.simpleString()

    def one(key, f: dict) -> list[tuple]:
        n = f["end"].count(None)  # lines come before problems
        if not n:
            return []
        return [(*key, *r) for r in _refined(f["idx"][:n], f["text"][:n], f["gap"][:n], f["head"][:n], list(zip(f["idx"][n:], f["end"][n:], f["open"][n:])), ask, least_gap)]

    # of a line no more is shown than this, so no more is shuffled
    own = lines.select(file, F.col("idx").cast("long").alias("idx"), F.left("text", F.lit(SHOWN)).alias("text"), F.col("gap").cast("double").alias("gap"), "head", F.lit(None).cast("long").alias("end"), F.lit(None).cast("boolean").alias("open"))
    nothing = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("text", "gap", "head")]
    asked = problems.select(file, F.col("start").cast("long").alias("idx"), *nothing, F.col("end").cast("long").alias("end"), "open")
    both = own.unionByName(asked).withColumn("_side", F.col("end").isNotNull())
    return by_group(both, [file], ["_side", "idx"], f"`{file}` {kind}, start long, first long, last long, status string", one)
