"""Hard negatives by a vertical scan with bounds (branch and bound on decomposed vectors).

Anchors, a stated query set, meet all rows in blocks.  In a block the vectors
lie column by column.  Each anchor reads the columns in the order of its own
falling magnitudes; after a few, the score of a row lies between its partial sum
plus the least and plus the greatest that the columns still unread can add (from
each column's smallest and largest component in the block).  Rows whose range
cannot matter any more leave the bitmap of candidates, until the exact scores of
those that stay settle the question.  Two rounds: the nearest rows of an anchor's
own label (positives), then rows of other labels within a window below each
positive (negatives).

A block of rows and a batch of anchors meet in one task; both are bounded, dealt
by a hash, and independent of labels, so no label, vector or anchor can be hot.

Rows with a null id, label or vector, or with a null or non-finite component,
take no part.  Of rows with one id the one of the smallest label and then vector
takes part.  A shorter vector is filled up with zeros.  Scores are 64-bit sums.
An empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linefold.llm.common import written
from linefold.session import Workspace

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these hundredths of the positive's.
LOW, HIGH = 50, 95
#: Rows of a block and anchors of a batch at most, about (dealt by a hash); columns read between two looks at the bounds.
BLOCK, BATCH, STEP = 8_192, 8_192, 8


def usable(vectors: DataFrame, label: Column) -> DataFrame:
    """vec_id, label, v (whole components), each id once."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & label.isNotNull() & F.col("embedding").isNotNull()).where(finite)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    one = rows.select("vec_id", F.struct(label.cast("long").alias("label"), v.alias("v")).alias("x")).groupBy("vec_id").agg(F.min("x").alias("x"))
    return one.select("vec_id", "x.label", "x.v")


def scan(cols: np.ndarray, least: np.ndarray, most: np.ndarray, a: np.ndarray, rows: np.ndarray, cut: Callable) -> tuple[np.ndarray, np.ndarray]:
    """The rows that ``cut`` leaves, with their exact scores against ``a``.

    ``cut(low, high)`` gets bounds of the candidates' scores and returns the bitmap of those that stay.
    """
    order = np.argsort(-np.abs(a), kind="stable")[: np.count_nonzero(a)]
    x, y = a[order] * least[order], a[order] * most[order]
    rest_low, rest_high = (np.append(e[::-1].cumsum()[::-1], 0) for e in (np.minimum(x, y), np.maximum(x, y)))
    sums = np.zeros(len(rows), np.int64)
    for at in range(0, len(order) + STEP, STEP):
        at = min(at, len(order))
        stay = cut(sums + rest_low[at], sums + rest_high[at])
        if not stay.all():
            rows, sums = rows[stay], sums[stay]
        if at == len(order) or not len(rows):
            break
        for d in order[at : at + STEP]:
            sums += a[d] * (cols[d] if len(rows) == cols.shape[1] else cols[d][rows])
    return rows, sums


def nearest(k: int) -> Callable:
    """Those whose upper bound reaches the k-th highest lower bound."""

    def cut(low, high):
        return high >= np.partition(low, -k)[-k] if len(low) > k else np.ones(len(low), bool)

    return cut


def within(windows: list[tuple[int, int]], k: int) -> Callable:
    """Those that can be among the k highest of a window; rows certain to lie in it set its mark."""
    low_most, high_most = min(w[0] for w in windows), max(w[1] for w in windows)

    def cut(low, high):
        stay = (high >= low_most) & (low <= high_most)
        if stay.any():
            near, far, some = low[stay], high[stay], np.zeros(int(stay.sum()), bool)
            for lo, hi in windows:
                sure = near[(near >= lo) & (far <= hi)]
                mark = max(lo, np.partition(sure, -k)[-k]) if len(sure) >= k else lo
                some |= (far >= mark) & (near <= hi)
            stay[stay] = some
        return stay

    return cut


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, of equals the smaller ids."""
    if len(score) > k:
        at = np.flatnonzero(score >= np.partition(score, -k)[-k])
        return at[np.lexsort((ids[at], -score[at]))[:k]]
    return np.lexsort((ids, -score))


class _Block:
    def __init__(self, rows: pa.Table):
        self.ids, self.labels = (rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("vec_id", "label"))
        self.cols = np.ascontiguousarray(_matrix(rows).T)
        self.least, self.most = self.cols.min(1), self.cols.max(1)


def _matrix(rows: pa.Table) -> np.ndarray:
    return rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, -1)


def _positives(k: int) -> Callable:
    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], []]
        if rows.num_rows and anchors.num_rows:
            b = _Block(rows)
            for i, label, a in zip(anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist(), _matrix(anchors)):
                own, score = scan(b.cols, b.least, b.most, a, np.flatnonzero((b.labels == label) & (b.ids != i)), nearest(k))
                top = best(score, b.ids[own], k)
                out[0] += [i] * len(top)
                out[1] += b.ids[own][top].tolist()
                out[2] += score[top].tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], ["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(k: int) -> Callable:
    def run(key, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out = [[], [], [], [], []]
        if rows.num_rows and anchors.num_rows:
            b = _Block(rows)
            for i, label, a, found in zip(anchors.column("vec_id").to_pylist(), anchors.column("label").to_pylist(), _matrix(anchors), anchors.column("positives").to_pylist()):
                spans = sorted({(p["low"], p["high"]) for p in found})
                other, score = scan(b.cols, b.least, b.most, a, np.flatnonzero(b.labels != label), within(spans, k))
                for p in found:
                    at = np.flatnonzero((score >= p["low"]) & (score <= p["high"]))
                    top = at[best(score[at], b.ids[other[at]], k)]
                    out[0] += [i] * len(top)
                    out[1] += [p["positive_id"]] * len(top)
                    out[2] += [p["positive_score"]] * len(top)
                    out[3] += b.ids[other[top]].tolist()
                    out[4] += score[top].tolist()
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([pa.array(c, pa.int64()) for c in out], names)

    return run


def mine(vectors: DataFrame, label: Column, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor the ``positives`` highest other rows of its label (of equals the smaller id), and for each of them the
    ``negatives`` highest rows of other labels with low * positive <= 100 * negative <= high * positive.
    """
    spark = vectors.sparkSession
    with Workspace(spark, "negatives") as work:
        rows, n = work.counted(usable(vectors, label), "rows")
        anchors, n_anchors = work.counted(rows.where(is_anchor), "anchors")
        longest = rows.agg(F.max(F.size("v"))).first()[0] or 0

        def padded(df: DataFrame) -> DataFrame:
            return df.withColumn("v", F.expr(f"concat(v, array_repeat(0L, {longest} - size(v)))"))

        blocks = max(1, math.ceil(n / BLOCK))
        enough = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))  # for all tasks to have work
        batches = max(1, math.ceil(n_anchors / BATCH), min(n_anchors, math.ceil(enough / blocks)))
        by = ["block", "batch"]

        def every(name: str, count: int) -> Column:
            return F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias(name)

        def dealt(name: str, count: int) -> Column:
            return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int").alias(name)

        sides = padded(rows).select("vec_id", "label", "v", dealt("block", blocks)).select("*", every("batch", batches)).groupBy(*by)

        def against(asking: DataFrame, fn: Callable, schema: str) -> DataFrame:
            asks = padded(asking).select("*", dealt("batch", batches)).select("*", every("block", blocks)).groupBy(*by)
            return sides.cogroup(asks).applyInArrow(fn, schema)

        def first(df: DataFrame, key: list[str], score: str, other: str, k: int) -> DataFrame:
            return df.withColumn("rank", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc(score), other))).where(F.col("rank") <= k)

        near = first(against(anchors, _positives(positives), "anchor_id long, positive_id long, positive_score long"), ["anchor_id"], "positive_score", "positive_id", positives)
        # hundredths of the score to whole numbers: up for the lower end, down for the upper one; none lies between if it is negative
        floor = lambda e: F.expr(f"({e} - pmod({e}, 100)) div 100")
        span = near.withColumn("low", -floor(f"(-{low} * positive_score)")).withColumn("high", floor(f"({high} * positive_score)")).where("low <= high")
        asked = span.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score", "low", "high")).alias("positives"))
        asked = work.written(anchors.join(asked.withColumnRenamed("anchor_id", "vec_id"), "vec_id"), "asked")
        found = against(asked, _negatives(negatives), "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
        out = first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
        return written(out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
