"""Keyed state by buckets of keys: calls that follow the buckets, several keys in one of them, odd rows."""

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest

from linefold.streaming import events as S
from linefold.streaming import reorder
from tests import test_jobs as T


def timers(q):
    return [int(s["customMetrics"].get("numRegisteredTimers", 0)) for p in q.recentProgress for s in p["stateOperators"]]


def test_jobs_wake_a_bucket_not_a_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(reorder, "BUCKETS", 8, raising=False)
    rows = T.feed(900, users=120, seed=3)
    T.write(spark, rows, tmp_path, 1, "a")
    got, q = T.Feed(spark, tmp_path, 20 * T.HOUR, "1 hour").go()
    assert got == T.jobs(rows, T.ms(rows[-1][1]) - T.HOUR, 20 * T.HOUR)
    assert max(timers(q)) <= 8  # with a timer for each key, 120


@pytest.mark.parametrize("chunk", [5, 65_536])
def test_jobs_of_one_bucket_over_restarts(spark, tmp_path, monkeypatch, chunk):
    """Open, closed and silent jobs of several keys side by side in one bucket's state."""
    monkeypatch.setattr(reorder, "BUCKETS", 1, raising=False)
    monkeypatch.setattr(reorder, "CHUNK", chunk, raising=False)
    rows = T.feed(240, users=5, seed=11)
    every = T.Feed(spark, tmp_path, 2 * T.HOUR, "3 hours", 1)
    for k in range(3):
        part = rows[k * 80 : (k + 1) * 80]
        T.write(spark, part[::-1], tmp_path, 1, f"part{k}-")
        got, q = every.go()
        assert reorder.late_rows(q) == 0
        assert got == T.jobs(rows[: (k + 1) * 80], T.ms(part[-1][1]) - 3 * T.HOUR, 2 * T.HOUR)


def test_jobs_of_null_keys_and_rows_without_a_time(spark, tmp_path):
    at = lambda h: T.START + dt.timedelta(hours=h)
    rows = [(1, at(0), None, "view", 0.0, None), (2, at(1), 0, "error", 0.0, None), (3, at(2), None, "purchase", 0.0, None), (4, None, None, "error", 0.0, None)]
    rows += [(5, at(3), 0, None, 0.0, None), (2**60 + 1, at(9), 0, "view", 0.0, None), (2**60 + 3, at(99), 7, "view", 0.0, None)]
    T.write(spark, rows, tmp_path, 1, "a")
    events = spark.readStream.schema(T.SCHEMA).parquet(f"{tmp_path}/events.parquet/*")
    got = {tuple(r)[:6] for r in S.run_append(reorder.jobs(events, T.ENDS, 12 * T.HOUR, "1 hour")).collect()}
    assert got == {(None, 1, 1, 3, 2, "done"), (0, 1, 2, 2, 1, "failed"), (0, 2, 5, 2**60 + 1, 2, "timed_out")}


def fell(value, before):
    """As SQL compares: nothing beside a null, NaN above all."""
    if value is None or before is None or math.isnan(value):
        return False
    return math.isnan(before) or value < before


def test_falls_of_keys_that_share_buckets(spark, tmp_path, monkeypatch):
    """Null keys, null values and NaN, out of order over several batches."""
    monkeypatch.setattr(reorder, "BUCKETS", 2, raising=False)
    rnd = random.Random(5)
    values = [None, math.nan, math.inf, -0.0, 0.0, 1.0, 2.0]
    rows = [(*r[:2], rnd.choice([None, 0, 1, 2, 3]), r[3], rnd.choice(values), None) for r in T.feed(200, seed=8)]
    mixed = [r for k in range(0, 200, 20) for r in rows[k : k + 20][::-1]]
    T.write(spark, mixed, tmp_path, 4, "f")
    events = spark.readStream.schema(T.SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events.parquet/*")
    got = {r[0]: r[1] for r in S.run_upsert(reorder.falls(events, "12 hours"), ["user_id"]).collect()}
    own = {u: [r[4] for r in rows if r[2] == u] for u in [None, 0, 1, 2, 3]}
    assert got == {u: sum(map(fell, v[1:], v)) for u, v in own.items()}


class Kept:
    """A handle, its list state, value state and timers in memory."""

    def __init__(self):
        self.entries, self.value, self.puts, self.timers = [], None, 0, set()
        self.getListState = lambda *_: self
        self.getValueState = lambda *_: type("Value", (), {"get": lambda _: self.value, "update": lambda _, v: setattr(self, "value", v)})()
        self.registerTimer, self.deleteTimer = self.timers.add, self.timers.remove
        self.get = lambda: iter(list(self.entries))
        self.appendList = self.entries.extend
        self.clear = self.entries.clear

    def put(self, entries):
        self.puts, self.entries[:] = self.puts + 1, entries


def test_rows_that_wait_are_not_written_again():
    kept, falls = Kept(), reorder.Falls()
    falls.init(kept)
    rng = np.random.default_rng(2)
    us, value = rng.permutation(1500) * 1000, rng.random(1500)
    at = lambda ms: type("Timers", (), {"getCurrentWatermarkInMs": lambda _: ms})()
    frame = pd.DataFrame({"bucket": 0, "none": False, "user": 7, "us": us, "event_id": us, "value": value, "unset": False, "at": 0})
    for k in range(0, 1500, 10):
        out = list(falls.handleInputRows((0,), iter([frame[k : k + 10]]), at(0)))
        seen = value[: k + 10][np.argsort(us[: k + 10])]
        assert out[0].to_numpy().tolist() == [[7, int((np.diff(seen) < 0).sum())]]
        assert len(kept.entries) <= reorder.ENTRIES and kept.timers == {int(us[: k + 10].min()) // 1000}
    assert kept.puts == 2  # of 150 batches
    kept.timers.clear()  # as Spark does with one that has expired
    assert list(falls.handleExpiredTimer((0,), at(1000), None)) == [] and kept.timers == {1000}
    assert sum(len(e[0]) for e in kept.entries) == 500 * falls.row.itemsize
