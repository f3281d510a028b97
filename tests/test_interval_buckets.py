"""Interval joins on buckets, where a point's reach is longer than a bucket."""

import datetime as dt

from linefold.plans import catalogue


def test_a_reach_of_three_buckets(spark, tmp_path):
    """The two hours and a minute around a point may hold a whole two-hour bucket and touch both of its neighbours."""
    base = dt.datetime(2024, 1, 1, 4)
    at = lambda minutes: base + dt.timedelta(minutes=minutes)
    points = [at(60.0), at(59.5), at(61), at(0), at(119)]
    spans = [at(m) for m in range(-70, 200, 1)]
    rows = [(i, t, 1, "error", 0.0) for i, t in enumerate(points)] + [(100 + i, t, 1, "purchase", 0.0) for i, t in enumerate(spans)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    far = lambda t, f: max((t - f).total_seconds(), (f - t).total_seconds() - 60, 0)
    near = [(i, 100 + k) for i, t in enumerate(points) for k, f in enumerate(spans) if far(t, f) <= 3600]
    got = catalogue.QUERIES["jon8_interval_nearest"](spark, str(tmp_path)).collect()
    assert sorted((r["event_id"], r["fig"]) for r in got) == near
    first = {fig: min(i for i, k in near if k == fig and abs(points[i] - spans[fig - 100]).total_seconds() <= 3600) for _, fig in near if any(abs(t - spans[fig - 100]).total_seconds() <= 3600 for t in points)}
    owners = catalogue.QUERIES["mtc4_figure_owners"](spark, str(tmp_path)).where("pass = 1").collect()
    assert {r["fig"]: r["p"] for r in owners} == first
