"""Characters in matching blocks, as difflib finds them, by sorted runs.

difflib takes the longest common run (of equal ones the first in a, then in b)
and goes on left and right of it; each step compares all equal characters anew.
Here the common runs of a window are found once, and each step picks among them.
"""

from __future__ import annotations

from bisect import bisect_left
from difflib import SequenceMatcher

import numpy as np

#: Pairs of equal places that are held at once, and windows (characters x characters) left to difflib.
MOST_PAIRS, SMALL = 2_000_000, 400


def matched(a: str, b: str, most: int = MOST_PAIRS) -> int:
    """Sum of the sizes of ``SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()``."""
    codes = lambda t: np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    x, y = codes(a), codes(b)
    n, todo = 0, [(0, len(a), 0, len(b), None)]  # a window, and the length that no run in it reaches
    while todo:
        a0, a1, b0, b1, below = todo.pop()
        if (a1 - a0) * (b1 - b0) <= SMALL:
            n += _by_difflib(a[a0:a1], b[b0:b1])
        elif below == 2:
            n += _single(a[a0:a1], b[b0:b1])
        elif (found := _runs(x[a0:a1], y[b0:b1], below, most)) is None:
            n += _by_difflib(a[a0:a1], b[b0:b1])
        else:
            k, *runs = found
            taken, rest = _picked(a1 - a0, b1 - b0, k, *runs)
            n += taken
            todo += [(a0 + i0, a0 + i1, b0 + j0, b0 + j1, k) for i0, i1, j0, j1 in rest]
    return n


def _by_difflib(a: str, b: str) -> int:
    return sum(x.size for x in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks())


def _single(a: str, b: str) -> int:
    """Without a common pair of characters: each time the first of a that b still has, and its first place there."""
    places: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        places.setdefault(c, []).append(j)
    n = at = 0
    for c in a:
        own = places.get(c, ())
        k = bisect_left(own, at)
        if k < len(own):
            n, at = n + 1, own[k] + 1
    return n


def _runs(x: np.ndarray, y: np.ndarray, below: int | None, most: int) -> tuple | None:
    """k and the places in x, in y and lengths of all common runs of k or more.

    k is the least power of two whose equal places are at most ``most``; None if it is not less than ``below``.
    """
    ids = np.unique(np.concatenate([x, y]), return_inverse=True)[1].astype(np.int64)
    gx, gy, k = ids[: len(x)], ids[len(x) :], 1
    while True:
        wide = np.int64(max(gx.max(initial=0), gy.max(initial=0)) + 1)
        gx, gy, k = gx[: max(0, len(gx) - k)] * wide + gx[k:], gy[: max(0, len(gy) - k)] * wide + gy[k:], 2 * k
        ids = np.unique(np.concatenate([gx, gy]), return_inverse=True)[1].astype(np.int64)
        gx, gy = ids[: len(gx)], ids[len(gx) :]
        if below is not None and k >= below:
            return None
        by = np.argsort(gy, kind="stable")
        low = np.searchsorted(gy[by], gx, "left")
        count = np.searchsorted(gy[by], gx, "right") - low
        pairs = int(count.sum())
        if pairs <= most:
            break
    i = np.repeat(np.arange(len(gx)), count)
    j = by[np.arange(pairs) - np.repeat(np.cumsum(count) - count - low, count)]
    width = len(x) + 1
    places = np.sort((i - j + len(y)) * width + i)  # along the diagonals
    first = np.flatnonzero(np.diff(places, prepend=-2) != 1)
    length = np.diff(first, append=pairs) + k - 1
    i = places[first] % width
    return k, i, i - (places[first] // width - len(y)), length


def _picked(n: int, m: int, k: int, i: np.ndarray, j: np.ndarray, length: np.ndarray) -> tuple[int, list[tuple]]:
    """Characters in the runs of k or more that are taken, and the windows left between them."""
    taken, rest, todo = 0, [], [(0, n, 0, m, i, j, length)]
    while todo:
        i0, i1, j0, j1, i, j, length = todo.pop()
        cut = np.maximum(0, np.maximum(i0 - i, j0 - j))
        i, j = i + cut, j + cut
        length = np.minimum(length - cut, np.minimum(i1 - i, j1 - j))
        held = length >= k
        i, j, length = i[held], j[held], length[held]
        if not len(length):
            if i0 < i1 and j0 < j1:
                rest.append((i0, i1, j0, j1))
            continue
        size = int(length.max())
        longest = np.flatnonzero(length == size)
        at = longest[np.lexsort((j[longest], i[longest]))[0]]
        p, q = int(i[at]), int(j[at])
        taken += size
        if i0 < p and j0 < q:
            side = (i < p) & (j < q)
            todo.append((i0, p, j0, q, i[side], j[side], length[side]))
        if p + size < i1 and q + size < j1:
            side = (i + length > p + size) & (j + length > q + size)
            todo.append((p + size, i1, q + size, j1, i[side], j[side], length[side]))
    return taken, rest
