"""Jobs with a terminal state or a timeout, over many files, restarts and late rows."""

import datetime as dt
import random

import pytest

from linefold.streaming import events as S
from linefold.streaming import reorder

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
HOUR = 3_600_000
ENDS = {"purchase": "done", "error": "failed"}
START = dt.datetime(2024, 1, 1)


def feed(n=300, users=7, seed=1):
    """Rows in the order of time, some at the same time."""
    rnd = random.Random(seed)
    rows, at = [], START
    for i in range(n):
        at += dt.timedelta(milliseconds=rnd.choice([0, 1, 400, 60_000, 1_800_000]))
        rows.append((i, at, rnd.randrange(users), rnd.choice(["view", "click", "signup", "purchase", "error"]), rnd.random(), None))
    return rows


def ms(t):
    return int((t - START).total_seconds() * 1000)


def jobs(rows, watermark, timeout):
    """The jobs that rows before ``watermark`` close, by a loop over each user."""
    out = []
    for user in {r[2] for r in rows}:
        open_rows, number = [], 1
        own = sorted((r for r in rows if r[2] == user and ms(r[1]) < watermark), key=lambda r: (r[1], r[0]))

        def close(state):
            nonlocal open_rows, number
            out.append((user, number, open_rows[0][0], open_rows[-1][0], len(open_rows), state))
            open_rows, number = [], number + 1

        for r in own:
            if open_rows and ms(r[1]) - ms(open_rows[-1][1]) > timeout:
                close("timed_out")
            open_rows.append(r)
            if r[3] in ENDS:
                close(ENDS[r[3]])
        if open_rows and ms(open_rows[-1][1]) + timeout < watermark:
            close("timed_out")
    return sorted(out)


def write(spark, rows, folder, files, name):
    """``files`` files of rows, in the order given."""
    step = -(-len(rows) // files)
    for k in range(files):
        spark.createDataFrame(rows[k * step : (k + 1) * step], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet/{name}{k:03d}")


class Feed:
    """A query over a folder that is started again and again with one checkpoint."""

    def __init__(self, spark, tmp, timeout, lateness, per_trigger=3):
        self.spark, self.tmp, self.timeout, self.lateness, self.per_trigger = spark, str(tmp), timeout, lateness, per_trigger

    def go(self):
        events = self.spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", self.per_trigger).parquet(f"{self.tmp}/events.parquet/*")
        out = reorder.jobs(events, ENDS, self.timeout, self.lateness)
        q = out.writeStream.format("parquet").option("checkpointLocation", f"{self.tmp}/log").outputMode("append").trigger(availableNow=True).start(f"{self.tmp}/out")
        q.awaitTermination()
        rows = self.spark.read.schema(out.schema).parquet(f"{self.tmp}/out").collect()
        return sorted(tuple(r)[:6] for r in rows), q


@pytest.mark.parametrize("timeout", [HOUR, 20 * HOUR])
def test_files_in_shuffled_order_within_the_lateness(spark, tmp_path, timeout):
    rows = feed()
    mixed = list(rows)
    random.Random(4).shuffle(mixed)
    write(spark, mixed, tmp_path, 8, "f")
    span = ms(rows[-1][1])
    got, q = Feed(spark, tmp_path, timeout, f"{span + 1} milliseconds").go()
    assert got == [] and reorder.late_rows(q) == 0  # the watermark has not passed anything yet
    # two rows far behind the others move it past them all
    last = [(1000 + k, rows[-1][1] + dt.timedelta(milliseconds=3 * span + k), 99, "view", 0.0, None) for k in range(2)]
    write(spark, last, tmp_path, 1, "g")
    got, q = Feed(spark, tmp_path, timeout, f"{span + 1} milliseconds").go()
    want = jobs(rows + last, ms(last[-1][1]) - span - 1, timeout)
    assert got == want and reorder.late_rows(q) == 0
    assert {r[5] for r in got} == {"done", "failed", "timed_out"}


def test_restart_between_batches(spark, tmp_path):
    rows = feed(seed=9)
    every = Feed(spark, tmp_path, 2 * HOUR, "1 hour", 1)
    seen = []
    for k in range(3):
        write(spark, rows[k * 100 : (k + 1) * 100], tmp_path, 2, f"part{k}-")
        got, q = every.go()
        assert reorder.late_rows(q) == 0
        assert set(seen) <= set(got)  # what was said stays said
        assert got == jobs(rows[: (k + 1) * 100], ms(rows[(k + 1) * 100 - 1][1]) - HOUR, 2 * HOUR)
        seen = got
    again, _ = every.go()
    assert again == seen


def test_late_rows_are_counted_and_left_out(spark, tmp_path):
    rows = feed(100, seed=2)
    write(spark, rows, tmp_path, 1, "a")
    every = Feed(spark, tmp_path, HOUR, "1 minute")
    before, _ = every.go()
    late = [(500 + k, START, k % 7, "error", 0.0, None) for k in range(5)]
    write(spark, late, tmp_path, 1, "b")
    after, q = every.go()
    assert reorder.late_rows(q) == 5 and after == before


def test_falls_need_no_history(spark, tmp_path):
    """Rows out of order within the lateness: counts as by time; the state holds only rows that still wait."""
    rows = feed(400, users=3, seed=6)
    mixed = [r for k in range(0, 400, 20) for r in rows[k : k + 20][::-1]]
    write(spark, mixed, tmp_path, 20, "f")
    events = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/events.parquet/*")
    got = {r[0]: r[1] for r in S.run_upsert(reorder.falls(events, "12 hours"), ["user_id"]).collect()}
    for user in range(3):
        v = [r[4] for r in rows if r[2] == user]
        assert got[user] == sum(b < a for a, b in zip(v, v[1:]))
