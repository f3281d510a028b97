"""Ordered folds: a choice that depends on the one before, also within groups that no single task may hold.

Small groups are one pass over rows sorted by group.  A group of more rows than a
chunk is cut by their places in it: each chunk is summarised as a function from the
state before it to the state after it, the functions of a group are applied one
after the other (a row a chunk), and then every chunk folds its rows from the
state it now knows.  Chunks of one group run beside each other in both passes.
"""

from __future__ import annotations

import pickle
from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from linefold.operators.ordered import numbered_wide

#: Rows of a chunk.
CHUNK = 1_000_000


def _rows(table: pa.Table | pa.RecordBatch, names: list[str]) -> Iterator[dict]:
    for values in zip(*(table.column(c).to_pylist() for c in names)):
        yield dict(zip(names, values))


def fold(df: DataFrame, group: list[str], order: str, new: str, step: Callable) -> DataFrame:
    """One pass over the rows of each group in order: ``step(state, row)`` returns the next state and a row of ``new`` or None.

    Rows come sorted by group within partitions, so a group takes time linear in its rows and no memory.
    """
    schema = T._parse_datatype_string(new)
    kinds = to_arrow_schema(schema)
    names = df.columns

    def run(batches):
        last, state = None, None
        for b in batches:
            out = []
            for row in _rows(b, names):
                key = tuple(row[g] for g in group)
                if key != last:
                    last, state = key, None
                state, made = step(state, row)
                if made is not None:
                    out.append(made)
            yield pa.RecordBatch.from_pylist(out, kinds)

    return df.repartition(*group).sortWithinPartitions(*group, order).mapInArrow(run, schema)


def by_group(df: DataFrame, group: list[str], order: list[str], new: str, made: Callable) -> DataFrame:
    """``made(key, columns)`` of each group's rows in order, given as lists by name, returns rows of ``new`` as tuples.

    Rows come sorted by group within partitions: one pass of Arrow batches, whatever the number of groups; a task holds one group at a time.
    """
    schema = T._parse_datatype_string(new)
    kinds, names = to_arrow_schema(schema), df.columns

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows) if rows else [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, kinds)], schema=kinds)

    def run(batches):
        last, held = None, []

        def done():
            return made(last, dict(zip(names, map(list, zip(*held))))) if held else []

        for b in batches:
            out = []
            columns = [b.column(c).to_pylist() for c in names]
            for key, row in zip(zip(*(columns[names.index(g)] for g in group)), zip(*columns)):
                if key != last:
                    out += done()
                    last, held = key, []
                held.append(row)
            yield packed(out)
        yield packed(done())

    return df.repartition(*group).sortWithinPartitions(*group, *order).mapInArrow(run, schema)


def wide_fold(df: DataFrame, group: list[str], order: str, new: str, step: Callable, summary: Callable, known: dict[str, Column] | None = None) -> DataFrame:
    """As ``fold``; groups of more than one chunk are folded chunk by chunk.

    ``summary(rows)`` of a chunk's rows in order returns a function (an object
    that can be pickled) with ``fold``'s state before the chunk as argument and
    the state after it as result.  Its rows also have the aggregates ``known`` of
    their group.
    """
    known = known or {}
    names, schema = df.columns, T._parse_datatype_string(new)
    kinds = to_arrow_schema(schema)
    spans = df.groupBy(*group).agg(F.count("*").alias("_n"), *[v.alias(k) for k, v in known.items()])
    spans = spans.where(F.col("_n") > CHUNK).select(*[F.col(g).alias(f"_of_{g}") for g in group], *known)
    if not spans.take(1):
        return fold(df, group, order, new, step)
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_of_{g}")) for g in group])
    small, large = df.join(spans, same, "left_anti"), df.join(spans, same).select(*names, *known)
    large = numbered_wide(large, group, [order], "_place").select(*names, *known, F.floor((F.col("_place") - 1) / CHUNK).alias("_chunk"))
    key, seen = [*group, "_chunk"], [*names, *known]
    of_key = T.StructType([large.schema[k] for k in key])

    def summed(at: tuple, rows: pa.Table) -> pa.Table:
        made = pickle.dumps(summary(list(_rows(rows.sort_by(order), seen))))
        cols = [pa.array([v.as_py()], rows.schema.field(k).type) for k, v in zip(key, at)]
        return pa.table([*cols, pa.array([made], pa.binary())], [*key, "f"])

    def passed(state, row: dict):
        return pickle.loads(row["f"])(state), {**{k: row[k] for k in key}, "before": pickle.dumps(state)}

    functions = large.groupBy(*key).applyInArrow(summed, T.StructType([*of_key, T.StructField("f", T.BinaryType())]))
    befores = fold(functions, group, "_chunk", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in of_key) + ", before binary", passed)

    def rest(at: tuple, rows: pa.Table, before: pa.Table) -> pa.Table:
        state, out = pickle.loads(before.column("before")[0].as_py()), []
        for row in _rows(rows.sort_by(order), names):
            state, made = step(state, row)
            if made is not None:
                out.append(made)
        return pa.Table.from_pylist(out, kinds)

    whole = large.groupBy(*key).cogroup(befores.groupBy(*key)).applyInArrow(rest, schema)
    return fold(small, group, order, new, step).unionByName(whole)


class Stretches:
    """Where the stretches taken from a chunk end, for each place at which the stretch before it may end.

    Of the rows in order, one is taken if it begins at or after the end of the one taken before.
    """

    def __init__(self, rows: list[dict]):
        starts = [r["idx"] for r in rows]
        ends: list[int] = [0] * len(rows)
        for i in range(len(rows) - 1, -1, -1):
            end = starts[i] + rows[i]["length"]
            after = bisect_left(starts, end, i + 1)
            ends[i] = ends[after] if after < len(rows) else end
        # a stretch from an earlier chunk ends before the first row here plus the longest stretch
        n = bisect_left(starts, starts[0] + rows[0]["longest"])
        self.starts, self.ends = starts[: n + 1], ends[: n + 1]
        self.last = starts[-1]

    def __call__(self, free):
        if free is not None and free > self.last:
            return free
        return self.ends[0 if free is None else bisect_left(self.starts, free)]


class Numbers:
    """The last number of a chunk of a chain for each last number before it.

    The first row with a number of its own gives that, or the next one if its
    digits begin with that; each of these few outcomes is followed to the end of
    the chunk.  Rows before it only go on counting.
    """

    def __init__(self, rows: list[dict]):
        at = next((i for i, r in enumerate(rows) if r["whole"] is not None), len(rows))
        lead = rows[:at]
        # digits beyond a number take part only where they begin with the next one: such rows stay as they are
        self.lead = [{k: r[k] for k in ("raw", "whole")} for r in lead] if any(is_number(r["raw"]) for r in lead) else sum(r["raw"] is not None for r in lead)
        self.fixed = at < len(rows)
        if self.fixed:
            raw = rows[at]["raw"]
            wants = {int(raw[:k]) for k in range(1, min(len(raw), 19))} - {rows[at]["whole"]}
            self.other = self._through(None, rows[at:])
            self.table = {want - 1: self._through(want - 1, rows[at:]) for want in wants}

    def _through(self, number, rows: list[dict]):
        for r in rows:
            number = next_number(number, r)[0]
        return number

    def __call__(self, number):
        if isinstance(self.lead, list):
            number = self._through(number, self.lead)
        elif number is not None:
            number += self.lead
        return self.table.get(number, self.other) if self.fixed else number


def is_number(raw: str | None) -> bool:
    return raw is not None and raw.isascii() and raw.isdigit()


def next_number(number: int | None, row: dict) -> tuple[int | None, tuple[int | None, bool]]:
    """The last number after a row (raw, whole), and the row's number and whether it was mended."""
    raw, whole, want = row["raw"], row["whole"], None if number is None else number + 1
    if raw is None:
        return number, (None, False)
    if not is_number(raw):
        found = want, True
    elif want is not None and whole != want and any(int(raw[:k]) == want for k in range(1, min(len(raw), 19))):
        found = want, True
    else:
        found = whole, False
    return (number if found[0] is None else found[0]), found
