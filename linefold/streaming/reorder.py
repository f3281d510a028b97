"""Keyed state with timers: rows that arrive in any order are handled in the order of their time.

Keys are dealt by hash into buckets, and a bucket is one key of Spark's state: a
call to the worker, its reads and its writes serve all keys of the bucket that
have rows, so their number grows with the buckets, not with keys or rows.  A
bucket's rows wait in its list state, in packed chunks, until the watermark has
passed their time; one timer at the earliest thing to do wakes the bucket.  So a
key holds the rows of the allowed lateness and what its fold remembers, never its
history.  Rows later than the watermark are dropped by Spark and counted
(``late_rows``).  A row without a time has no place in the order and takes no part.

A bucket is held whole by a worker (a row in 35 bytes or less): a feed with more
rows within its lateness takes more ``buckets``.  A checkpoint keeps its number.

Timers are in milliseconds: a row is released when its millisecond lies before
the watermark.  Rows of one millisecond come in the order of time and id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
BUCKETS = 2048
#: Rows of one entry of a bucket's list.
CHUNK = 65_536
#: A list of so many entries is written anew as full ones.
ENTRIES = 64
#: A key as it is kept: whether it is null, and its number.
KEY = [("none", "?"), ("user", "i8")]
#: Stands for a null id, behind all others of its time.
NO_ID = 2**63 - 1


def with_timers(spark: SparkSession) -> None:
    """Timers and list state need the store on disk; a session that has chosen one keeps it."""
    if "RocksDB" not in spark.conf.get(STORE, ""):
        spark.conf.set(STORE, ROCKS)


def joined(kind: np.dtype, *parts: dict | np.ndarray) -> np.ndarray:
    """Records of ``kind`` from arrays or dicts of columns, one after the other; a column that a part lacks is 0."""
    sizes = [len(p["user"]) for p in parts]
    out, at = np.zeros(sum(sizes), kind), 0
    for p, n in zip(parts, sizes):
        for name in p if isinstance(p, dict) else p.dtype.names:
            out[name][at : at + n] = p[name]
        at += n
    return out


def chunks(rows: np.ndarray) -> list[tuple[bytes]]:
    return [(rows[i : i + CHUNK].tobytes(),) for i in range(0, len(rows), CHUNK)]


def by_key(records: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Records with each key's together, otherwise as they come, and whether a record is of the same key as the one before."""
    r = records[np.lexsort((records["user"], records["none"]))]
    same = np.zeros(len(r), bool)
    same[1:] = (r["user"][1:] == r["user"][:-1]) & (r["none"][1:] == r["none"][:-1])
    return r, same


def longs(values: np.ndarray, null: np.ndarray) -> pd.Series:
    return pd.Series(pd.arrays.IntegerArray(values.copy(), null.copy()))


class Reordered(StatefulProcessor):
    """Buffers the rows of a bucket and hands them on in order.

    A subclass names with ``columns`` what a row holds beside key, us and event_id,
    and with ``memory`` what is remembered of a key; ``fold`` takes the rows that
    are released, of all keys of the bucket.
    """

    columns: list[tuple[str, str]] = []
    memory: list[tuple[str, str]] = []

    def init(self, handle) -> None:
        self.handle = handle
        self.row = np.dtype([*KEY, ("us", "i8"), ("event_id", "i8"), *self.columns])
        self.kept = np.dtype([*KEY, *self.memory])
        self.waiting = handle.getListState("waiting", "rows binary")
        self.known = handle.getValueState("known", "memory binary, timer long")

    def fold(self, memory: np.ndarray, rows: np.ndarray, now: int) -> tuple[np.ndarray, np.ndarray | None]:
        """What is remembered after ``rows`` (in the order of time) at the watermark ``now``, and what comes out."""
        raise NotImplementedError

    def wakes(self, memory: np.ndarray) -> np.ndarray:
        """The milliseconds after which the bucket is woken although no row came."""
        return np.empty(0, "i8")

    def results(self, out: np.ndarray | None, memory: np.ndarray, waiting: np.ndarray, fresh: np.ndarray) -> Iterator[pd.DataFrame]:
        raise NotImplementedError

    def close(self) -> None:
        pass

    def handleInputRows(self, key, rows, timerValues):
        # the first column is the bucket, the last the time as Spark's watermark needs it
        parts = [joined(self.row, {name: f.iloc[:, 1 + i].to_numpy() for i, name in enumerate(self.row.names)}) for f in rows]
        yield from self._go(timerValues, np.concatenate(parts), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._go(timerValues, np.empty(0, self.row), True)

    def _go(self, timers, fresh: np.ndarray, expired: bool) -> Iterator[pd.DataFrame]:
        now = timers.getCurrentWatermarkInMs()
        packed, timer = self.known.get() or (b"", None)
        old = [np.frombuffer(chunk, self.row) for (chunk,) in self.waiting.get()] if packed or timer is not None else []
        rows = np.concatenate([*old, fresh])
        rows = rows[np.lexsort((rows["event_id"], rows["us"]))]
        n = int(np.searchsorted(rows["us"] // 1000, now))
        memory, out = self.fold(np.frombuffer(packed, self.kept), rows[:n], now)
        rest = rows[n:]
        if not n and len(old) < ENTRIES:  # none is released: the fresh rows go behind the others, which are not written again
            if len(fresh):
                self.waiting.appendList(chunks(fresh))
        elif len(rest):
            self.waiting.put(chunks(rest))
        elif old:
            self.waiting.clear()
        due = [*(rest["us"][:1] // 1000).tolist(), *self.wakes(memory).tolist()]
        due = min(due) if due else None
        if due != timer or expired:
            if timer is not None and not expired:  # one that has expired is removed by Spark
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.known.update((memory.tobytes(), due))
        yield from self.results(out, memory, rest, fresh)


def keyed(events: DataFrame, key: str, columns: list[Column], lateness: str, processor: Reordered, schema: str, mode: str, buckets: int | None) -> DataFrame:
    """``processor`` over ``events`` by ``key``; ``columns`` in the order of the processor's."""
    with_timers(events.sparkSession)
    at = F.col("ts").cast("timestamp")
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets or BUCKETS)).cast("int").alias("bucket")
    kept = [F.col(key).isNull().alias("none"), F.coalesce(F.col(key).cast("long"), F.lit(0)).alias("user")]
    rows = events.withColumn("at", at).withWatermark("at", lateness).where("at IS NOT NULL")
    rows = rows.select(bucket, *kept, F.unix_micros("at").alias("us"), F.coalesce("event_id", F.lit(NO_ID)).alias("event_id"), *columns, "at")
    return rows.groupBy("bucket").transformWithStateInPandas(processor, schema, mode, "EventTime")


class Jobs(Reordered):
    """A key's rows from one terminal kind to the next are a job; it is closed by such a row, or by silence.

    ``states`` are those of the terminal kinds, which a row's ``end`` numbers from
    1; timed_out, if more than ``timeout_ms`` pass after the job's last row.  A row
    after that opens a new job.  Of a key its newest job is remembered, without
    rows (n = 0) if that is closed.
    """

    columns = [("end", "i2")]
    memory = [("number", "i8"), ("first_id", "i8"), ("last_id", "i8"), ("last_us", "i8"), ("n", "i8")]
    record = np.dtype([*KEY, *memory, *columns])

    def __init__(self, states: list[str], timeout_ms: int):
        self.states, self.timeout_ms = np.array([*states, "timed_out"], object), timeout_ms

    def fold(self, memory, rows, now):
        # every row as a job of its own, behind the jobs that are remembered
        ones = {x: rows[x] for x in ("none", "user", "end")} | {x: rows["event_id"] for x in ("first_id", "last_id")} | {"last_us": rows["us"], "number": 1, "n": 1}
        r, same = by_key(joined(self.record, memory, ones))
        ms = r["last_us"] // 1000
        starts = ~same
        starts[1:] |= (r["end"][:-1] > 0) | (r["n"][:-1] == 0) | (ms[1:] - ms[:-1] > self.timeout_ms)
        first = np.flatnonzero(starts)
        last = np.append(first[1:], len(r))[: len(first)] - 1
        jobs = r[last]
        jobs["first_id"] = r["first_id"][first]
        jobs["n"] = np.add.reduceat(r["n"], first) if len(first) else 0
        # numbers go up from that of the key's first record
        opens = ~same[first]
        place = np.arange(len(first))
        began = np.maximum.accumulate(np.where(opens, place, 0))
        jobs["number"] = r["number"][first][began] + place - began
        newest = np.append(opens[1:], True)[: len(first)]
        silent = jobs["last_us"] // 1000 + self.timeout_ms < now
        closed = (jobs["n"] > 0) & ((jobs["end"] > 0) | ~newest | silent)
        out = jobs[closed]
        jobs["n"][closed] = 0
        return jobs[newest][list(self.kept.names)].astype(self.kept), out

    def wakes(self, memory):
        return memory["last_us"][memory["n"] > 0] // 1000 + self.timeout_ms

    def results(self, out, memory, waiting, fresh):
        if len(out):
            ids = {x: longs(out[x], out[x] == NO_ID) for x in ("first_id", "last_id")}
            state = self.states[out["end"] - 1]  # 0, no end, is the last
            yield pd.DataFrame({"user_id": longs(out["user"], out["none"]), "job": out["number"], **ids, "n": out["n"], "state": state, "last_us": out["last_us"]})


def jobs(events: DataFrame, ends: dict[str, str], timeout_ms: int, lateness: str, buckets: int | None = None) -> DataFrame:
    """user_id, job (from 1), first_id, last_id, n, state, last_us of each job that has come to an end, as a stream."""
    schema = "user_id long, job long, first_id long, last_id long, n long, state string, last_us long"
    end = F.lit(0)
    for i, kind in enumerate(ends, 1):
        end = F.when(F.col("event_type") == kind, i).otherwise(end)
    return keyed(events, "user_id", [end.cast("short").alias("end")], lateness, Jobs(list(ends.values()), timeout_ms), schema, "append", buckets)


class Falls(Reordered):
    """How often a key's value falls; rows that still wait are counted where they stand now.

    NaN is above all numbers; beside a null nothing falls.
    """

    columns = [("value", "f8"), ("unset", "?")]
    memory = [("falls", "i8"), *columns]

    def fold(self, memory, rows, now):
        if not len(rows):
            return memory, None
        r, same = by_key(joined(self.kept, memory, {x: rows[x] for x in ("none", "user", "value", "unset")}))
        value, before = r["value"][1:], r["value"][:-1]
        less = (value < before) | (np.isnan(before) & ~np.isnan(value))
        fell = np.zeros(len(r), "i8")
        fell[1:] = same[1:] & less & ~r["unset"][1:] & ~r["unset"][:-1]
        first = np.flatnonzero(~same)
        new = r[np.append(first[1:], len(r)) - 1]
        new["falls"] = np.add.reduceat(r["falls"] + fell, first)
        return new, None

    def results(self, out, memory, waiting, fresh):
        if len(fresh):  # a timer changes no count
            stand, _ = self.fold(memory, waiting, 0)
            stand = stand[np.isin(stand["user"], fresh["user"])]
            yield pd.DataFrame({"user_id": longs(stand["user"], stand["none"]), "inversions": stand["falls"]})


def falls(events: DataFrame, lateness: str, buckets: int | None = None) -> DataFrame:
    """user_id, inversions so far, in the order of time; a key's state holds the rows of the lateness, a count and a value."""
    value = [F.coalesce("value", F.lit(0.0)).alias("value"), F.col("value").isNull().alias("unset")]
    return keyed(events, "user_id", value, lateness, Falls(), "user_id long, inversions long", "update", buckets)


def late_rows(query) -> int:
    """Rows that came after the watermark had passed them, over the batches that a finished query still knows."""
    return sum(int(s.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for s in p["stateOperators"])
