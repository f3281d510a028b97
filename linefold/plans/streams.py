"""Queries that run as Structured Streaming over the events table (STR), each to completion over all its rows."""

from __future__ import annotations

from linefold.plans.registry import query
from linefold.streaming import events as S
from linefold.streaming import reorder


@query(
    "str1_parsed_events",
    "SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_type <> 'error'",
)
def str1(spark, d):
    return S.run_append(S.parsed(S.source(spark, d)).where("event_type != 'error'").select("event_id", "user_id", "k"))


@query("str2_unparsed_events", "SELECT event_id, left(event_type, 500) AS raw FROM events WHERE event_type = 'error'")
def str2(spark, d):
    """Rows whose payload is no JSON, kept as text."""
    return S.run_append(S.unparsed(S.source(spark, d)))


@query("str3_latest_per_key", "SELECT user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def str3(spark, d):
    return S.run_upsert(S.latest(S.source(spark, d)), ["user_id"])


@query("str4_latency_summary", "SELECT event_type, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n FROM events GROUP BY 1")
def str4(spark, d):
    return S.run_upsert(S.summary(S.source(spark, d)), ["event_type"])


@query("str5_out_of_order", "SELECT user_id, count(*) FILTER (value < p) AS inversions FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) GROUP BY 1")
def str5(spark, d):
    """How often a key's value falls in the order of time, whatever the order of arrival.

    The lateness is longer than the table, whose files may come in any order; a
    feed in about the order of time needs little.
    """
    return S.run_upsert(reorder.falls(S.source(spark, d), "40 days"), ["user_id"])


@query(
    "str6_jobs",
    """WITH e AS (SELECT user_id, event_id, event_type, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ms FROM events), w AS (SELECT max(ms) - 3600000 AS wm FROM e),
    r AS (SELECT e.*, wm, lag(event_type) OVER k AS before, ms - lag(ms) OVER k AS gap FROM e, w WHERE ms < wm WINDOW k AS (PARTITION BY user_id ORDER BY us, event_id)),
    j AS (SELECT *, sum(CASE WHEN before IS NULL OR before IN ('purchase', 'error') OR gap > 43200000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS job FROM r),
    c AS (SELECT user_id, CAST(job AS BIGINT) AS job, arg_min(event_id, (us, event_id)) AS first_id, arg_max(event_id, (us, event_id)) AS last_id, count(*) AS n,
        arg_max(event_type, (us, event_id)) AS kind, max(us) AS last_us, max(job) = max(max(job)) OVER (PARTITION BY user_id) AS newest, any_value(wm) AS wm FROM j GROUP BY user_id, job)
    SELECT user_id, job, first_id, last_id, n, CASE kind WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'timed_out' END AS state, last_us FROM c
    WHERE kind IN ('purchase', 'error') OR NOT newest OR last_us // 1000 + 43200000 < wm""",
)
def str6(spark, d):
    """A user's jobs, closed by a terminal event or by twelve hours of silence as the watermark tells; open ones stay in the state."""
    ends = {"purchase": "done", "error": "failed"}
    return S.run_append(reorder.jobs(S.source(spark, d), ends, 12 * 3_600_000, "1 hour"))


@query("str9_tumbling", "SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def str9(spark, d):
    """Extension: event-time windows of an hour."""
    return S.run_upsert(S.tumbling(S.source(spark, d), "1 hour"), ["start_us", "event_type"])


@query(
    "str10_sliding",
    """SELECT epoch_us(time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR * k) AS start_us, event_type, count(*) AS n FROM events, range(2) AS r(k) GROUP BY 1, 2""",
)
def str10(spark, d):
    """Extension: two-hour windows that slide by an hour."""
    return S.run_upsert(S.tumbling(S.source(spark, d), "2 hours", "1 hour"), ["start_us", "event_type"])


@query(
    "str8_error_rows",
    """SELECT event_id, 'error' AS state FROM events WHERE event_type = 'error' UNION ALL SELECT event_id, 'done' FROM events WHERE event_type <> 'error'""",
)
def str8(spark, d):
    """Rows that fail go on as error rows beside the others; only a batch's first failure would stop it."""
    return S.run_split(S.source(spark, d))


@query("snk5_event_log", "SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_type = 'error' THEN left(event_type, 500) END AS unparsed FROM events")
def snk5(spark, d):
    """The feed as an appended JSON log, unparsed payloads kept as text, read back."""
    return S.run_log(S.source(spark, d))
