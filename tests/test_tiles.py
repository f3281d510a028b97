"""Connected cells over many tiles against a flood over whole pages."""

import random

import pytest

from linefold.operators import blobs as B


def flooded(cells, least_cells=1, side=1, least_area=0):
    out = []
    for page in {p for p, _, _ in cells}:
        left = {(x, y) for p, x, y in cells if p == page}
        found = []
        for start in sorted(left):
            if start not in left:
                continue
            left.discard(start)
            todo, seen = [start], [start]
            while todo:
                x, y = todo.pop()
                for near in [(x + dx, y + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]:
                    if near in left:
                        left.discard(near)
                        todo.append(near)
                        seen.append(near)
            xs, ys = [c[0] for c in seen], [c[1] for c in seen]
            box = min(xs), min(ys), max(xs), max(ys)
            if len(seen) >= least_cells and (box[2] - box[0] + 1) * (box[3] - box[1] + 1) * side * side >= least_area:
                found.append((len(seen), *box))
        out += [(page, k, *b) for k, b in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("tile", [1, 3, 8, 256])
def test_blobs_over_tiles(spark, monkeypatch, tile):
    """Random cells, a spiral through all tiles, negative places, repeated and null cells."""
    monkeypatch.setattr(B, "TILE", tile)
    rnd = random.Random(tile)
    cells = [(rnd.choice([1, 2]), rnd.randrange(-20, 20), rnd.randrange(-20, 20)) for _ in range(500)]
    x = y = dx = 0
    dy, n = -2, 15
    for k in range(1, n):  # a path of two cells a step, one cell apart from itself
        for _ in range(k):
            cells += [(3, 2 * x, 2 * y), (3, 2 * x + (dx > 0) - (dx < 0), 2 * y + (dy > 0) - (dy < 0))]
            x, y = x + (dx > 0) - (dx < 0), y + (dy > 0) - (dy < 0)
        dx, dy = -dy, dx
    df = spark.createDataFrame(cells + cells[:50] + [(None, 1, 1), (1, None, 0)], "page long, cx long, cy long").repartition(4)
    got = B.blobs(df, "page")
    assert got.columns == ["page", "blob", "cells", "x0", "y0", "x1", "y1"]
    assert sorted(map(tuple, got.collect())) == flooded(cells)
    assert sorted(map(tuple, B.blobs(df, "page", 4, 10, 900).collect())) == flooded(cells, 4, 10, 900)


def test_no_cells(spark):
    assert B.blobs(spark.createDataFrame([], "page long, cx long, cy long"), "page").count() == 0
