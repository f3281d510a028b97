"""Queries for window programs (WIN)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import merging, ordered
from linefold.operators.extract import segment_exits
from linefold.plans.groups import _GAP_SQL, gaps
from linefold.plans.registry import query
from linefold.plans.markers_sql import ENDED_SQL
from linefold.plans.rows import MARKED_SQL, MARKERS, marked
from linefold.sources.tables import LINES_SQL, lines, table


@query("win1_reading_order", "SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY coalesce(nullif(CAST(floor(value) AS BIGINT) % 9, 0), 1000000), ts, event_id) AS BIGINT) AS idx FROM events")
def win1(spark, d):
    """Order within a file; a missing line number sorts last, arrival order breaks ties."""
    line = F.coalesce(F.nullif(F.floor("value") % 9, F.lit(0)), F.lit(1_000_000))
    return ordered.numbered(table(spark, d, "events"), ["user_id"], [line, "ts", "event_id"]).select("event_id", "idx")


@query("win2_line_gaps", f"WITH {_GAP_SQL} SELECT event_id, gap, gap > 3600 AS far FROM g WHERE gap IS NOT NULL")
def win2(spark, d):
    return gaps(spark, d).where("gap is not null").select("event_id", "gap", (F.col("gap") > 3600).alias("far"))


@query(
    "win3_rolling_text",
    f"WITH {LINES_SQL} SELECT doc_id, idx, regexp_matches(string_agg(text, '') OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), 'tion[.] ?$|ing[.]The') AS has_end FROM lines",
)
def win3(spark, d):
    ahead = ordered.ahead_text(F.col("text"), 8, ["doc_id"], ["idx"])
    return lines(spark, d).select("doc_id", "idx", ahead.rlike("tion[.] ?$|ing[.]The").alias("has_end"))


@query("win4_look_behind", "SELECT event_id, coalesce(max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) = 1 AS after_error FROM events")
def win4(spark, d):
    return table(spark, d, "events").select("event_id", ordered.any_near(F.col("event_type") == "error", 3, -1, ["user_id"], ["ts", "event_id"]).alias("after_error"))


@query("win5_last_head", "SELECT event_id, last_value(CASE WHEN event_type = 'search' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING) AS head FROM events")
def win5(spark, d):
    head = ordered.carried(F.when(F.col("event_type") == "search", F.col("event_id")), ["user_id"], ["ts", "event_id"], back=40, current=False)
    return table(spark, d, "events").select("event_id", head.alias("head"))


@query(
    "win6_carried_state",
    f"WITH {MARKED_SQL} SELECT doc_id, idx, coalesce(last_value(CASE WHEN name IN ('title', 'license') THEN name = 'title' END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING), FALSE) AS in_corner FROM marked",
)
def win6(spark, d):
    """A state that each head switches, held within its file."""
    flag = F.when(F.col("name").isin("title", "license"), F.col("name") == "title")
    return marked(spark, d).select("doc_id", "idx", F.coalesce(ordered.carried(flag, ["doc_id"], ["idx"]), F.lit(False)).alias("in_corner"))


_SEG_SQL = f"""{MARKED_SQL}, kept AS (SELECT * FROM marked WHERE text <> ''),
    seg AS (SELECT *, CAST(sum(CASE WHEN name IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY idx) AS BIGINT) AS segment FROM kept)"""


@query("win7_segments", f"WITH {_SEG_SQL} SELECT doc_id, segment, min(idx) AS first, count(*) AS n_lines, CAST(sum(length(text)) AS BIGINT) AS chars FROM seg GROUP BY 1, 2")
def win7(spark, d):
    """Lines, ordered, cut into segments at each marker, and counted."""
    t = marked(spark, d).where("text != ''")
    t = t.withColumn("segment", ordered.run_id(F.col("name").isNotNull(), ["doc_id"], ["idx"]))
    return t.groupBy("doc_id", "segment").agg(F.min("idx").alias("first"), F.count("*").alias("n_lines"), F.sum(F.length("text")).alias("chars"))


def _ends(lines):
    """The segment ends of plain text lines, with markers of the synthetic texts in the parts of a book's."""
    m = lines.withColumn("name", X.match_marker("text", MARKERS)["name"])
    m = m.withColumn("start", ordered.carried(F.when(F.col("name").isin("title", "number", "license"), F.col("idx")), ["doc_id"], ["idx"])).where("start is not null")
    t = F.col("text")
    flags = {
        "page": F.floor(F.col("idx") / 10),
        "is_head_line": F.coalesce(F.col("name") == "license", F.lit(False)) & (F.col("idx") != F.col("start")),
        "far": F.length(t) > 900,
        "passive": t == "",
        "joined": t.rlike("^[a-z]"),
        "order_end": t.rlike(r"tion[.]\s*$"),
        "rider": F.contains(t, F.lit(", the")),
        "sub": F.coalesce(F.col("name") == "list", F.lit(False)),
        "solution": F.coalesce(F.col("name") == "shout", F.lit(False)),
        "kind": F.first("name").over(Window.partitionBy("doc_id", "start").orderBy("idx")),
    }
    return segment_exits(m.withColumns(flags), ["doc_id"], ["title"], max_lines=12)


@query("win8_segment_ends", ENDED_SQL)
def win8(spark, d):
    """Where each segment ends and why: the first line with an exit reason, reasons in priority order."""
    return _ends(lines(spark, d))


@query(
    "win9_neighbour_duplicates",
    "SELECT event_id FROM (SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p, event_type FROM events) WHERE p IS DISTINCT FROM event_type",
)
def win9(spark, d):
    """Rows that do not repeat their neighbour's key."""
    p = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return table(spark, d, "events").withColumn("p", p).where(~F.col("p").eqNullSafe(F.col("event_type"))).select("event_id")


@query(
    "win11_sequence_gaps",
    """WITH n AS (SELECT DISTINCT o_custkey AS k, o_orderkey % 50 AS v FROM orders), x AS (SELECT k, v, lead(v) OVER (PARTITION BY k ORDER BY v) AS nx FROM n),
    m AS (SELECT k, unnest(range(v + 1, nx)) AS missing FROM x WHERE nx - v > 1) SELECT k, missing FROM m QUALIFY row_number() OVER (PARTITION BY k ORDER BY missing) <= 12""",
)
def win11(spark, d):
    """The first 12 numbers missing from each sequence."""
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 50).alias("v"))
    return ordered.missing_between(o, ["k"], "v", 12)


@query(
    "win11_sequence_check",
    """WITH e AS (SELECT user_id, ts, event_id, CAST(floor(value) AS BIGINT) AS v FROM events),
    x AS (SELECT *, lag(v) OVER w AS p FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    r AS (SELECT *, CAST(sum(CASE WHEN v <= p THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS run FROM x),
    g AS (SELECT user_id, run, unnest(range(p + 1, v)) AS missing FROM r WHERE v - p > 1),
    f AS (SELECT user_id, run, list(missing ORDER BY missing)[1:12] AS missing, count(*) AS n_missing FROM g GROUP BY 1, 2)
    SELECT user_id, run, min(v) AS first, max(v) AS last, count(*) AS n, coalesce(any_value(n_missing), 0) AS n_missing, coalesce(array_to_string(any_value(f.missing), ','), '') AS missing
    FROM r LEFT JOIN f USING (user_id, run) GROUP BY 1, 2""",
)
def win11_check(spark, d):
    """Runs that a number not above its predecessor breaks, and of each run the first 12 numbers missing between its first and its last."""
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").select("user_id", "ts", "event_id", F.floor("value").alias("v")).withColumn("p", F.lag("v").over(order))
    e = e.withColumn("fall", F.coalesce((F.col("v") <= F.col("p")).cast("int"), F.lit(0))).withColumn("run", F.sum("fall").over(order))
    # within a run numbers rise, so what is missing lies between neighbours; of one gap no more than 12 can be among the first
    gap = F.greatest(F.col("v") - F.col("p") - 1, F.lit(0))
    e = e.withColumn("gap", F.coalesce(gap, F.lit(0)))
    most = F.when(F.col("gap") > 0, F.sequence(F.col("p") + 1, F.least(F.col("v") - 1, F.col("p") + 12)))
    before = F.sum("gap").over(Window.partitionBy("user_id", "run").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1))
    e = e.withColumn("some", F.when(F.coalesce(before, F.lit(0)) < 12, most))
    out = e.groupBy("user_id", "run").agg(
        F.min("v").alias("first"), F.max("v").alias("last"), F.count("*").alias("n"), F.sum("gap").alias("n_missing"), F.array_sort(F.flatten(F.collect_list("some"))).alias("all")
    )
    return out.select("user_id", "run", "first", "last", "n", "n_missing", F.array_join(F.slice("all", 1, 12), ",").alias("missing"))


@query(
    "win11b_restarts",
    "SELECT user_id, CAST(sum(CASE WHEN v <= p THEN 1 ELSE 0 END) + 1 AS BIGINT) AS runs FROM (SELECT user_id, floor(value) AS v, lag(floor(value)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) GROUP BY 1",
)
def win11b(spark, d):
    """Runs that a value not above its predecessor breaks."""
    p = F.lag("v").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    e = table(spark, d, "events").withColumn("v", F.floor("value")).withColumn("p", p)
    return e.groupBy("user_id").agg((F.count_if(F.col("v") <= F.col("p")) + 1).alias("runs"))


_MATCHED_SQL = "m AS (SELECT DISTINCT o_custkey AS k, o_orderkey % 50 AS v FROM orders)"


@query("win12_scope_fill", f"WITH {_MATCHED_SQL}, x AS (SELECT k, v, lead(v) OVER (PARTITION BY k ORDER BY v) AS nx FROM m) SELECT k, v FROM m UNION SELECT k, unnest(range(v + 1, nx)) FROM x WHERE nx - v - 1 BETWEEN 1 AND 15")
def win12(spark, d):
    """Gaps of at most 15 between matched numbers are in scope."""
    m = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 50).alias("v")).distinct()
    x = m.withColumn("nx", F.lead("v").over(Window.partitionBy("k").orderBy("v")))
    upto = F.when((F.col("nx") - F.col("v") - 1).between(1, 15), F.col("nx") - 1).otherwise(F.col("v"))
    return x.select("k", F.explode(F.sequence("v", upto)).alias("v"))


@query(
    "win13_islands",
    f"WITH {_MATCHED_SQL}, g AS (SELECT k, v, v - row_number() OVER (PARTITION BY k ORDER BY v) AS grp FROM m) SELECT k, min(v) AS first, max(v) AS last, count(*) AS n FROM g GROUP BY k, grp",
)
def win13(spark, d):
    return ordered.islands(table(spark, d, "orders").select(F.col("o_custkey").alias("k"), (F.col("o_orderkey") % 50).alias("v")), ["k"], "v")


@query(
    "win14_restart_point",
    """WITH x AS (SELECT user_id, event_id, ts, CAST(floor(value) AS BIGINT) AS v, max(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen,
    max(CAST(floor(value) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS ahead FROM events)
    SELECT user_id, event_id FROM x WHERE v <= 3 AND seen >= 20 AND ahead < seen - 5 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""",
)
def win14(spark, d):
    """The first place where numbers restart low and stay low."""
    o = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = table(spark, d, "events").withColumn("v", F.floor("value"))
    e = e.withColumn("seen", F.max("v").over(o.rowsBetween(Window.unboundedPreceding, -1))).withColumn("ahead", F.max("v").over(o.rowsBetween(0, 2)))
    first = F.min(F.struct("ts", "event_id")).alias("at")
    return e.where("v <= 3 and seen >= 20 and ahead < seen - 5").groupBy("user_id").agg(first).select("user_id", "at.event_id")


@query(
    "win15_near_context",
    f"WITH {MARKED_SQL} SELECT doc_id, idx, first_value(name IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near FROM marked",
)
def win15(spark, d):
    w = Window.partitionBy("doc_id").orderBy("idx").rowsBetween(-3, 3)
    return marked(spark, d).select("doc_id", "idx", F.first("name", ignorenulls=True).over(w).alias("near"))


@query(
    "win16_context_lines",
    f"WITH {LINES_SQL}, h AS (SELECT *, max(CASE WHEN contains(text, '###') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS near FROM lines) SELECT doc_id, idx FROM h WHERE near = 1",
)
def win16(spark, d):
    hit = ordered.any_near(F.contains("text", F.lit("###")), 2, 2, ["doc_id"], ["idx"])
    return lines(spark, d).withColumn("near", hit).where("near").select("doc_id", "idx")


_SESSION_SQL = f"{_GAP_SQL}, s AS (SELECT *, CAST(sum(CASE WHEN gap > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM g)"


def sessions(spark, d):
    return gaps(spark, d).withColumn("session", ordered.run_id(F.col("gap") > 3600, ["user_id"], ["ts", "event_id"]))


@query("win17_blocks_by_gap", f"WITH {_SESSION_SQL} SELECT user_id, session, count(*) AS n, min(event_id) AS first FROM s GROUP BY 1, 2")
def win17(spark, d):
    """Blocks that a wide gap separates."""
    return sessions(spark, d).groupBy("user_id", "session").agg(F.count("*").alias("n"), F.min("event_id").alias("first"))


@query(
    "win18_block_with_anchor",
    f"WITH {_SESSION_SQL}, a AS (SELECT DISTINCT user_id, session FROM s WHERE event_type = 'purchase') SELECT event_id FROM s JOIN a USING (user_id, session)",
)
def win18(spark, d):
    """All rows of the blocks that hold an anchor."""
    w = Window.partitionBy("user_id", "session")
    s = sessions(spark, d).withColumn("has", F.max((F.col("event_type") == "purchase").cast("int")).over(w))
    return s.where("has = 1").select("event_id")


@query(
    "win19_merged_lines",
    """WITH u AS (SELECT *, CAST(sum(CASE WHEN p IS NOT DISTINCT FROM role THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS unit FROM
    (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations))
    SELECT conv_id, unit, min(role) AS role, string_agg(text, ' ' ORDER BY turn) AS merged FROM u GROUP BY 1, 2""",
)
def win19(spark, d):
    """Turns of one role that follow each other are one unit."""
    c = table(spark, d, "conversations")
    p = F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn"))
    c = c.withColumn("p", p).withColumn("unit", ordered.run_id(~F.col("p").eqNullSafe(F.col("role")), ["conv_id"], ["turn"]))
    return c.groupBy("conv_id", "unit").agg(F.min("role").alias("role"), X.ordered_concat(["turn"], "text", " ").alias("merged"))


@query(
    "win19_units",
    f"""WITH {LINES_SQL}, k AS (SELECT *, CASE WHEN contains(text, '|') THEN 'figure' WHEN regexp_matches(text, '^[0-9]') THEN 'box' ELSE 'text' END AS kind,
        CASE WHEN regexp_matches(text, '^[a-z]') THEN ' ' END AS glue, regexp_matches(text, '^(th|de)') AS particle FROM lines),
    s AS (SELECT *, CASE WHEN kind = 'figure' THEN NULL WHEN kind = 'box' THEN ' ' WHEN glue IS NOT NULL THEN CASE WHEN particle THEN '' ELSE glue END
        WHEN text <> '' AND lag(kind) OVER w = 'box' AND idx % 3 <> 0 THEN CASE WHEN particle THEN '' ELSE ' ' END END AS sep FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY idx)),
    u AS (SELECT *, sum(CASE WHEN sep IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx) AS unit, CASE WHEN kind = 'box' THEN '□' ELSE text END AS t FROM s WHERE kind <> 'figure'),
    f AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit, t <> '' ORDER BY idx) = 1 AS is_first FROM u)
    SELECT doc_id, min(idx) AS first, 'text' AS kind, coalesce(string_agg(CASE WHEN is_first THEN t ELSE coalesce(sep, '') || t END, '' ORDER BY idx) FILTER (t <> ''), '') AS text, count(*) AS n FROM f GROUP BY doc_id, unit
    UNION ALL SELECT doc_id, idx, 'figure', text, 1 FROM k WHERE kind = 'figure'""",
)
def win19_units(spark, d):
    """Lines of a document put together: continuations, boxes and what stands beside them; figures are skipped over."""
    t = F.col("text")
    kind = F.when(F.contains("text", F.lit("|")), "figure").when(t.rlike("^[0-9]"), "box").otherwise("text")
    # every third line stands lower than the box before it reaches
    y = F.col("idx") * 20.0 + F.when(F.col("idx") % 3 == 0, 100.0).otherwise(0.0)
    rows = lines(spark, d).select("doc_id", "idx", "text", kind.alias("kind"), F.when(t.rlike("^[a-z]"), " ").alias("glue"), F.lit(1).alias("page"), y.alias("y"), F.lit(15.0).alias("height"))
    rows = rows.withColumn("y", F.when(F.col("kind") == "box", F.col("idx") * 20.0).otherwise(F.col("y")))
    return merging.units(rows, "doc_id", t.rlike("^(th|de)"))


@query(
    "win20_next_kind",
    "SELECT event_id, first_value(CASE WHEN event_type <> 'error' THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_kind FROM events",
)
def win20(spark, d):
    """The next kind that did not fail, as a carried value over the reverse order."""
    kind = F.when(F.col("event_type") != "error", F.col("event_type"))
    return table(spark, d, "events").select("event_id", ordered.carried(kind, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], current=False).alias("next_kind"))


@query("win21_out_of_order", "SELECT user_id, count(*) FILTER (value < p) AS inversions FROM (SELECT user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM events) GROUP BY 1")
def win21(spark, d):
    e = table(spark, d, "events").withColumn("p", F.lag("value").over(Window.partitionBy("user_id").orderBy("event_id")))
    return e.groupBy("user_id").agg(F.count_if(F.col("value") < F.col("p")).alias("inversions"))


@query(
    "win22_history_delta",
    "SELECT o_custkey, o_orderkey, round(o_totalprice - lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), 2) AS delta, o_totalprice < lag(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS better FROM orders",
)
def win22(spark, d):
    """Difference to the previous run of the tag; lower is better."""
    p = F.lag("o_totalprice").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    o = table(spark, d, "orders").withColumn("p", p)
    return o.select("o_custkey", "o_orderkey", F.round(F.col("o_totalprice") - F.col("p"), 2).alias("delta"), (F.col("o_totalprice") < F.col("p")).alias("better"))


@query(
    "win23_page_chunks",
    """WITH n AS (SELECT conv_id, max(turn) + 1 AS pages FROM conversations GROUP BY 1), c AS (SELECT conv_id, unnest(range(0, greatest(pages - 1, 1), 3)) AS start FROM n)
    SELECT c.conv_id, c.start, string_agg(t.role, ',' ORDER BY t.turn) AS roles FROM c JOIN conversations t ON t.conv_id = c.conv_id AND t.turn BETWEEN c.start AND c.start + 3 GROUP BY 1, 2""",
)
def win23(spark, d):
    """Windows of 4 pages, 3 apart: each page says which windows it is in, so no range join is needed."""
    c = table(spark, d, "conversations")
    last = F.max("turn").over(Window.partitionBy("conv_id"))
    starts = F.filter(F.sequence(F.floor(F.col("turn") / 3) - 1, F.floor(F.col("turn") / 3)), lambda k: (k >= 0) & (k * 3 + 3 >= F.col("turn")) & (k * 3 < F.greatest(F.col("last"), F.lit(1))))
    t = c.withColumn("last", last).withColumn("start", F.explode(F.transform(starts, lambda k: k * 3)))
    return t.groupBy("conv_id", "start").agg(X.ordered_concat(["turn"], "role", ",").alias("roles"))


@query(
    "win24_label_before",
    "SELECT doc_id, CASE WHEN contains(left(text, 120), '###') THEN 'hash' WHEN contains(left(text, 120), '$$$') THEN 'cash' WHEN contains(left(text, 120), '|') THEN 'bar' ELSE 'none' END AS label FROM documents",
)
def win24(spark, d):
    head = F.substring("text", 1, 120)
    label = F.when(F.contains(head, F.lit("###")), "hash").when(F.contains(head, F.lit("$$$")), "cash").when(F.contains(head, F.lit("|")), "bar").otherwise("none")
    return table(spark, d, "documents").select("doc_id", label.alias("label"))
