"""Verbatim search of a stated query set in all texts.

The items are taken in blocks of about ``MOST_CHARS`` characters.  Each block
is broadcast and becomes one automaton a task, which reads every text once,
however many items the block has.  A task names an item once.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

MOST_CHARS = 1_000_000


def held(items: DataFrame, key: str, text: str, docs: DataFrame, body: str) -> DataFrame:
    """Distinct keys of the items that some text holds.

    A null item or text matches nothing; an empty item lies in every text.
    """
    bodies = docs.select(F.col(body).alias("body")).where("body is not null")
    rows = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    blocks = _blocks(rows.toLocalIterator())  # the driver holds one at a time
    parts = [_found(block, items.schema[key], bodies) for block in blocks] or [_found([], items.schema[key], bodies)]
    return reduce(DataFrame.union, parts).distinct()


def _blocks(rows: Iterable) -> Iterator[list]:
    block, size = [], 0
    for row in rows:
        block.append((row["key"], row["text"]))
        size += len(row["text"]) + 1
        if size >= MOST_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def _found(block: list, key: T.StructField, bodies: DataFrame) -> DataFrame:
    shared = bodies.sparkSession.sparkContext.broadcast(block)
    kind, schema = to_arrow_type(key.dataType), T.StructType([key])

    def run(batches):
        same: dict[str, list] = {}
        for k, t in shared.value:
            same.setdefault(t, []).append(k)
        find = ahocorasick.Automaton()
        for t in same:
            if t:
                find.add_word(t, t)
        find.make_automaton()
        known: set[str] = set()
        for b in batches:
            seen = {""} & same.keys() if b.num_rows else set()
            for body in b.column("body") if len(find) else ():
                seen.update(t for _, t in find.iter(body.as_py()))
            fresh = [k for t in seen - known for k in same[t]]
            known |= seen
            yield pa.RecordBatch.from_arrays([pa.array(fresh, kind)], schema.names)

    return bodies.mapInArrow(run, schema)
