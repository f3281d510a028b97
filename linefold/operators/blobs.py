"""Connected cells of a page, by tiles: labels within a tile, then the union of labels that touch across borders.

A tile is one call; a page of many tiles is many.  Only cells at the border of a
tile meet those of the next one, and only labels that touch take part in the
union, which contracts its graph until no edge is left.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linefold.session import Workspace, written

#: Cells along a side of a tile.
TILE = 256


def _labelled(f: pd.DataFrame) -> pd.DataFrame:
    """The first cell (by x, then y) of each cell's component within the tile, by flooding from it."""
    f = f.sort_values(["cx", "cy"])
    x, y = f["cx"].to_numpy(), f["cy"].to_numpy()
    place = {c: i for i, c in enumerate(zip(x.tolist(), y.tolist()))}
    root = np.full(len(f), -1)
    for c, i in place.items():
        if root[i] >= 0:
            continue
        root[i], todo = i, [c]
        while todo:
            a, b = todo.pop()
            for near in [(a + dx, b + dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]:
                k = place.get(near)
                if k is not None and root[k] < 0:
                    root[k] = i
                    todo.append(near)
    return f.assign(rx=x[root], ry=y[root])


def _united(work: Workspace, edges: DataFrame) -> DataFrame | None:
    """(node, root) of all nodes with an edge: the graph is contracted towards the neighbour with the least hash, a new one each round."""
    roots, turn = None, 0
    edges, n = work.counted(edges, "edges")
    while n:
        turn += 1
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(turn)), F.col(c).alias("n"))
        to = both.groupBy("node").agg(F.least(F.min(rank("other")), F.min(rank("node")))["n"].alias("to"))
        to = work.written(to, "to")
        step = to.select(F.col("node").alias("root"), F.col("to").alias("next"))
        moved = to.select("node", F.col("to").alias("root")) if roots is None else roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        roots = work.written(moved, "roots")
        a = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
        edges, n = work.counted(a.where("ta != tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "edges")
    return roots


def blobs(cells: DataFrame, page: str, least_cells: int = 1, side: int = 1, least_area: int = 0) -> DataFrame:
    """Connected cells (8 neighbours) of each page: blob number (by first cell), cells, bounding box.

    Repeated cells count once; rows with a null page or coordinate take no part.
    Blobs of fewer than ``least_cells`` cells, or whose box of cells of ``side``
    is smaller than ``least_area``, are left out before they are numbered.
    """
    spark = cells.sparkSession
    with Workspace(spark, "blobs") as work:
        c = cells.select(F.col(page).alias("page"), F.col("cx").cast("long").alias("cx"), F.col("cy").cast("long").alias("cy")).dropna().distinct()
        tile = [F.floor(F.col(a) / TILE).alias(f"t{a}") for a in ("cx", "cy")]
        kind = c.schema["page"].dataType.simpleString()
        c = c.select("*", *tile).groupBy("page", "tcx", "tcy").applyInPandas(_labelled, f"page {kind}, cx long, cy long, tcx long, tcy long, rx long, ry long")
        c = work.written(c, "labelled")
        label = F.struct("page", "tcx", "tcy", "rx", "ry").alias("label")

        def at_border(a: str):
            return F.pmod(F.col(a), F.lit(TILE)).isin(0, TILE - 1)

        border = c.where(at_border("cx") | at_border("cy")).select("page", "cx", "cy", "tcx", "tcy", label)
        # towards the greater x, and straight down: each touching pair is seen once
        ways = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in ((1, -1), (1, 0), (1, 1), (0, 1))])).alias("way")
        ahead = border.select("page", "cx", "cy", "tcx", "tcy", F.col("label").alias("a"), ways)
        ahead = ahead.select("page", (F.col("cx") + F.col("way.dx")).alias("cx"), (F.col("cy") + F.col("way.dy")).alias("cy"), F.col("tcx").alias("ux"), F.col("tcy").alias("uy"), "a")
        ahead = ahead.where((F.floor(F.col("cx") / TILE) != F.col("ux")) | (F.floor(F.col("cy") / TILE) != F.col("uy")))
        touching = ahead.join(border.select("page", "cx", "cy", F.col("label").alias("b")), ["page", "cx", "cy"])
        roots = _united(work, touching.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

        first = F.min(F.struct("rx", "ry")).alias("first")
        box = [F.count("*").alias("cells"), F.min("cx").alias("x0"), F.min("cy").alias("y0"), F.max("cx").alias("x1"), F.max("cy").alias("y1")]
        parts = c.groupBy("page", label).agg(first, *box)
        if roots is not None:
            parts = parts.join(roots.withColumnRenamed("node", "label"), "label", "left").withColumn("label", F.coalesce("root", "label"))
        least = lambda n: F.min(n).alias(n)
        most = lambda n: F.max(n).alias(n)
        whole = parts.groupBy("page", "label").agg(least("first"), F.sum("cells").alias("cells"), least("x0"), least("y0"), most("x1"), most("y1"))
        area = (F.col("x1") - F.col("x0") + 1) * (F.col("y1") - F.col("y0") + 1) * side * side
        whole = whole.where((F.col("cells") >= least_cells) & (area >= least_area))
        number = F.row_number().over(Window.partitionBy("page").orderBy("first")).cast("long") - 1
        return written(whole.select(F.col("page").alias(page), number.alias("blob"), "cells", "x0", "y0", "x1", "y1"), "blobs")
