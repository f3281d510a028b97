"""Set-similarity operators over character n-grams.

Both sides are dealt by hash into blocks that meet in one task each, where the
common n-grams of all their pairs are counted in one vectorised step.  Nothing
is gathered on the driver or broadcast, and no n-gram, however common, becomes a
join key.  Without ``on``, every batch of left rows meets every block of right
rows, which are as many as the right side is large; texts are shuffled as they
are and taken apart where they meet.  With ``on``, rows meet within a key (a tag
or file), of which a large one is cut into blocks of its own.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from linefold.functions.text import grams

#: Left rows of a batch; right rows of a block, where a key has more.
BATCH, BLOCK = 5_000, 20_000
#: n-grams of a block of right rows where no key tells them apart, and those that a task takes apart at a time.
BLOCK_GRAMS, STEP_GRAMS = 8_000_000, 1_000_000
#: Places of common n-grams (right row, left row) that a task counts at a time, a right row at least.
CELLS = 4_000_000
#: Rows of either side in a bin of small keys.
BIN = 20_000


def gram_sets(df: DataFrame, key: list[str], text: str, n: int = 3) -> DataFrame:
    """key, grams (hashed to 64 bits), size."""
    return df.select(*key, F.transform(grams(text, n), lambda g: F.xxhash64(g)).alias("grams")).withColumn("size", F.size("grams").cast("long"))


def overlaps(
    left: DataFrame, right: DataFrame, left_key: list[str], right_key: list[str], on: list[str] | None = None, keep: Callable = lambda inter, a, b: inter > 0, most: Callable | None = None
) -> DataFrame:
    """Pairs with a common n-gram: keys, inter, left_size, right_size, jaccard, containment.

    Rows have ``grams`` (64-bit hashes, or hashed here) and their ``size``; or both
    sides have ``text`` instead, whose trigrams are made where they are counted.  ``on`` names columns (part of both keys) that must be equal as
    well.  ``keep(inter, left_size, right_size)`` says which pairs matter; it is
    written with operators only, runs where the pairs are counted, and holds the
    rather the more n-grams are common.  ``most()`` tells how many n-grams the
    right side has at most, if that is known without making it.
    """
    on = on or []

    def side(df: DataFrame, key: list[str]) -> DataFrame:
        named = [F.col(k).alias(k) for k in key]  # named anew: both sides may be one table
        if "text" in df.columns:
            return df.where("text != ''").select(*named, F.col("text").alias("text"))
        hashed = F.col("grams") if df.schema["grams"].dataType == T.ArrayType(T.LongType(), df.schema["grams"].dataType.containsNull) else F.transform("grams", lambda g: F.xxhash64(g))
        return df.select(*named, F.col("size").cast("long").alias("size"), hashed.alias("grams"))

    a, b = side(left, left_key), side(right, right_key)
    n = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if on:
        a, b = _by_key(a, b, left_key, right_key, on)
        bins = max(4 * n, -(-(left.count() + right.count()) // BIN))
        group = [F.pmod(F.xxhash64("_tag"), F.lit(bins)).alias("_bin"), "_block", "_batch"]
    else:
        a, b = _in_blocks(a, b, left_key, right_key, most, n)
        group = ["_block", "_batch"]
    others = [k for k in right_key if k not in on]
    out = T.StructType([*[left.schema[k] for k in left_key], *[right.schema[k] for k in others]]).add("left_size", "long").add("right_size", "long").add("inter", "long")

    def run(rows: pa.Table, against: pa.Table) -> pa.Table:
        found = [pa.table([*[rows.column(k).take(i) for k in left_key], *[against.column(k).take(r) for k in others], size_a, size_b, inter], out.names) for i, r, size_a, size_b, inter in _counted(rows, against, keep)]
        return pa.concat_tables(found) if found else None

    empty = [f.dataType for f in out]

    def one(key, rows: pa.Table, against: pa.Table) -> pa.Table:
        made = run(rows, against) if rows.num_rows and against.num_rows else None
        return made if made is not None else pa.table([pa.array([], to_arrow_type(t)) for t in empty], out.names)

    return _ratios(a.groupBy(*group).cogroup(b.groupBy(*group)).applyInArrow(one, out))


def _dealt(key: list[str], parts: Column) -> Column:
    return F.pmod(F.xxhash64(*key), parts).cast("int")


def _every(parts: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))


def _by_key(a: DataFrame, b: DataFrame, left_key: list[str], right_key: list[str], on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of a key meet; a key with many rows is cut into batches x blocks.  The counts read the keys alone."""
    tag = F.xxhash64(*on).alias("_tag")
    parts = lambda df, most, name: df.groupBy(tag).agg(F.ceil(F.count("*") / most).alias(name))
    both = parts(a, BATCH, "_batches").join(parts(b, BLOCK, "_blocks"), "_tag")
    a = a.withColumn("_tag", tag).join(both, "_tag").withColumn("_batch", _dealt(left_key, F.col("_batches"))).withColumn("_block", _every(F.col("_blocks")))
    b = b.withColumn("_tag", tag).join(both, "_tag").withColumn("_block", _dealt(right_key, F.col("_blocks"))).withColumn("_batch", _every(F.col("_batches")))
    return a.drop("_batches", "_blocks"), b.drop("_batches", "_blocks")


def _in_blocks(a: DataFrame, b: DataFrame, left_key: list[str], right_key: list[str], most: Callable | None, n: int) -> tuple[DataFrame, DataFrame]:
    """Every batch of left rows meets every block of right rows; a right row goes once to each batch, and a block has so many n-grams at most, whatever the input."""
    weight = F.length("text") if "text" in b.columns else F.col("size")
    total = most() if most else b.agg(F.sum(weight)).first()[0]
    batches, blocks = F.lit(max(1, -(-a.count() // BATCH))), F.lit(max(2 * n, -(-(total or 0) // BLOCK_GRAMS)))
    a = a.withColumn("_batch", _dealt(left_key, batches)).withColumn("_block", _every(blocks))
    b = b.withColumn("_block", _dealt(right_key, blocks)).withColumn("_batch", _every(batches))
    return tuple(df.repartition(n, "_block", "_batch") for df in (a, b))  # comparing costs far more than the bytes tell: no coalescing


def _text_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct trigrams of each text, as its three code points in one number, and the text's place; a shorter text is one, padded."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    seen = np.zeros(0x110000, bool)
    seen[points] = True
    alphabet = np.append(np.int64(0), np.flatnonzero(seen) + 1)  # from 1, so that 0 is no character
    code = np.cumsum(seen, dtype=np.int64)
    bits = int(len(alphabet) - 1).bit_length()
    c = np.append(code[points], [0, 0])
    row = np.repeat(np.arange(len(texts)), n)
    place = np.arange(len(points)) - np.repeat(np.cumsum(n) - n, n)
    length = n[row]
    begins = (place < length - 2) | (place == 0)
    at = np.flatnonzero(begins)
    row, length = row[at], length[at]
    second, third = np.where(length > 1, c[at + 1], 0), np.where(length > 2, c[at + 2], 0)
    gram = (c[at] << 2 * bits) | (second << bits) | third
    if 3 * bits + len(texts).bit_length() <= 63:
        both = np.sort((row << 3 * bits) | gram)
        both = both[np.append(True, both[1:] != both[:-1])[: len(both)]]
        row, gram = both >> 3 * bits, both & ((1 << 3 * bits) - 1)
    else:
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        fresh = np.append(True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1]))[: len(row)]
        row, gram = row[fresh], gram[fresh]
    mask = (1 << bits) - 1
    return (alphabet[gram >> 2 * bits] << 42) | (alphabet[(gram >> bits) & mask] << 21) | alphabet[gram & mask], row


def _flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each n-gram, mixed with its row's tag, if any, so that only rows of one tag share it; its row; and the rows' sizes."""
    if "text" in rows.column_names:
        gram, row = _text_grams(rows.column("text").to_pylist())
        return gram ^ _tags(rows)[row], row, np.bincount(row, minlength=rows.num_rows)
    grams = rows.column("grams").combine_chunks()
    n = np.diff(grams.offsets.to_numpy()) if grams.null_count == 0 else np.array([len(g or ()) for g in grams.to_pylist()])
    row = np.repeat(np.arange(rows.num_rows), n)
    gram = grams.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return gram ^ _tags(rows)[row] if "_tag" in rows.column_names else gram, row, rows.column("size").to_numpy()


def _tags(rows: pa.Table) -> np.ndarray:
    return rows.column("_tag").to_numpy() if "_tag" in rows.column_names else np.zeros(rows.num_rows, np.int64)


def _cuts(weights: np.ndarray, most: int) -> np.ndarray:
    """Where rows are cut, so that the weights between two cuts are ``most`` or those of one row."""
    ends, cuts = np.cumsum(weights), [0]
    while cuts[-1] < len(weights):
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, (ends[cuts[-1] - 1] if cuts[-1] else 0) + most, "right"))))
    return np.array(cuts)


def _needed(keep: Callable, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """For each right size the least number of common n-grams with which some left row is kept; more than it has, if none is."""
    own, place = np.unique(sizes_b, return_inverse=True)
    a, b = np.unique(sizes_a[sizes_a > 0])[None, :], own[:, None]
    top = np.minimum(a, b)
    low, high = np.ones_like(top), top + 1  # the first that is kept lies within
    for _ in range(int(top.max(initial=1)).bit_length() + 1):
        mid = np.minimum((low + high) // 2, np.maximum(top, 1))
        good = keep(mid, a, b) & (b > 0)
        open_ = low < high
        high, low = np.where(open_ & good, mid, high), np.where(open_ & ~good, mid + 1, low)
    return np.where(high <= top, high, own.max(initial=0) + 1).min(axis=1, initial=own.max(initial=0) + 1)[place]


def _counted(rows: pa.Table, against: pa.Table, keep: Callable):
    """Places (in either table), sizes and common n-grams of the pairs that are kept, step by step over the right rows.

    Right rows without enough n-grams of any left row are left out.
    """
    gram, item, sizes_a = _flat(rows)
    order = np.argsort(gram, kind="stable")
    items = item[order]
    vocab, first = np.unique(gram[order], return_index=True)
    first = np.append(first, len(items))
    if not len(vocab):
        return
    tag_a, tag_b, width = _tags(rows), _tags(against), len(sizes_a)
    weights = pc.utf8_length(against.column("text")) if "text" in against.column_names else against.column("size")
    cuts = _cuts(weights.to_numpy().astype(np.int64), STEP_GRAMS)
    for start, stop in zip(cuts[:-1], cuts[1:]):
        flat, row, sizes_b = _flat(against.slice(start, stop - start))
        if not len(flat):
            continue
        at = np.minimum(np.searchsorted(vocab, flat), len(vocab) - 1)
        hit = vocab[at] == flat
        hit &= (np.bincount(row[hit], minlength=len(sizes_b)) >= _needed(keep, sizes_a, sizes_b))[row]
        at, row = at[hit], row[hit]
        n = first[at + 1] - first[at]
        steps = _cuts(np.bincount(row, n, len(sizes_b)).astype(np.int64), CELLS)
        for begin, end in zip(steps[:-1], steps[1:]):
            lo, hi = np.searchsorted(row, (begin, end))
            if lo == hi:
                continue
            here, mine, times = at[lo:hi], row[lo:hi] - begin, n[lo:hi]
            found = items[np.repeat(first[here] - np.cumsum(times) + times, times) + np.arange(times.sum())]
            cells = np.repeat(mine, times) * width + found
            if (end - begin) * width <= 4 * len(cells):
                count = np.bincount(cells)
                cell = np.flatnonzero(count)
                count = count[cell]
            else:
                cell, count = np.unique(cells, return_counts=True)
            i, r = cell % width, cell // width + begin
            good = keep(count, sizes_a[i], sizes_b[r]) & (tag_a[i] == tag_b[r + start])
            i, r, count = i[good], r[good], count[good]
            if len(i):
                yield pa.array(i), pa.array(r + start), pa.array(sizes_a[i]), pa.array(sizes_b[r]), pa.array(count)


def _ratios(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("jaccard", F.col("inter") / (F.col("left_size") + F.col("right_size") - F.col("inter"))).withColumn(
        "containment", F.col("inter") / F.least("left_size", "right_size")
    )


def best_match(pairs: DataFrame, key: list[str], score: str, other: str, least: float) -> DataFrame:
    """Per key the partner with the highest score of at least ``least``; of equals the smallest."""
    best = F.max(F.struct(F.col(score).alias("score"), (-F.col(other)).alias("o"))).alias("b")
    return pairs.where(F.col(score) >= least).groupBy(*key).agg(best).select(*key, F.col("b.score").alias(score), (-F.col("b.o")).alias(other))
