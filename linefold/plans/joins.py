"""Queries for joins, matching and similarity (JON, MTC)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import blobs, matching, ordered, similarity, verbatim
from linefold.plans.registry import query
from linefold.plans.rows import GRAMS_SQL, MARKED_SQL, marked
from linefold.sources.tables import LINES_SQL, lines, table


@query(
    "jon1_parent_not_shell",
    """WITH c AS (SELECT doc_id, n_chars, doc_id - doc_id % 10 AS pid FROM documents)
    SELECT c.doc_id FROM c LEFT JOIN (SELECT doc_id AS pid, max(n_chars) AS n FROM documents GROUP BY 1) p USING (pid) WHERE c.pid = c.doc_id OR p.n IS NULL OR p.n < 500""",
)
def jon1(spark, d):
    """A child stays if it has no parent or its parent is a shell; of parents with the same id the last counts."""
    docs = table(spark, d, "documents").select("doc_id", "n_chars", (F.col("doc_id") - F.col("doc_id") % 10).alias("pid"))
    parent = docs.groupBy(F.col("doc_id").alias("pid")).agg(F.max("n_chars").alias("n"))
    own = (F.col("pid") == F.col("doc_id")) | F.col("n").isNull() | (F.col("n") < 500)
    return docs.join(parent, "pid", "left").where(own).select("doc_id")


@query("jon2_group_lookup", "SELECT c.c_custkey, n.n_name, r.r_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey")
def jon2(spark, d):
    """Lookups by key; Catalyst broadcasts sides below its threshold by their measured size."""
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))
    return c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select("c_custkey", "n_name", "r_name")


@query("jon3_review_anti", "SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM conversations s WHERE s.conv_id = c.conv_id AND s.role = 'system')")
def jon3(spark, d):
    c = table(spark, d, "conversations")
    return c.join(c.where("role = 'system'").select("conv_id").distinct(), "conv_id", "left_anti").select("conv_id", "turn")


@query("jon4_index_anti", f"WITH {MARKED_SQL} SELECT doc_id, idx FROM marked WHERE (doc_id, idx) NOT IN (SELECT doc_id, idx FROM marked WHERE name IS NOT NULL)")
def jon4(spark, d):
    """An anti-join on (doc, index) with a part of the same table is a flag: no join runs."""
    return marked(spark, d).where("name is null").select("doc_id", "idx")


@query("jon5_orphans", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def jon5(spark, d):
    used = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")).distinct()
    return table(spark, d, "part").join(used, "p_partkey", "left_anti").select("p_partkey")


@query("jon6_missed", "SELECT item_id FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))")
def jon6(spark, d):
    """Items that no document holds verbatim: a stated query set, in blocks, against all texts."""
    b = table(spark, d, "benchmark")
    hit = verbatim.held(b, "item_id", "text", table(spark, d, "documents"), "text")
    return b.join(hit, "item_id", "left_anti").select("item_id")


@query(
    "jon7_band_members",
    """WITH b AS (SELECT user_id, floor(value / 5) AS k, count(*) AS n FROM events GROUP BY 1, 2), c AS (SELECT user_id, (k + 0.5) * 5 AS centre FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS m FROM b) WHERE n >= 8 OR n = m)
    SELECT event_id FROM events e WHERE EXISTS (SELECT 1 FROM c WHERE c.user_id = e.user_id AND abs(e.value - c.centre) <= 2.5)""",
)
def jon7(spark, d):
    """Rows within 2.5 of a learnt centre: a row can only lie near the centres of its own and the next buckets, so it is an equi-join."""
    e = table(spark, d, "events").select("event_id", "user_id", "value", F.floor(F.col("value") / 5).alias("k"))
    b = e.groupBy("user_id", "k").agg(F.count("*").alias("n")).withColumn("m", F.max("n").over(Window.partitionBy("user_id")))
    centres = b.where("n >= 8 or n = m").select("user_id", "k", ((F.col("k") + 0.5) * 5).alias("centre"))
    near = e.withColumn("k", F.explode(F.array(F.col("k") - 1, F.col("k"), F.col("k") + 1)))
    return near.join(centres, ["user_id", "k"]).where(F.abs(F.col("value") - F.col("centre")) <= 2.5).select("event_id").distinct()


@query(
    "jon8_interval_nearest",
    """WITH s AS (SELECT user_id, event_id, epoch_us(ts) // 1000 AS t FROM events WHERE event_type = 'error'), f AS (SELECT user_id, event_id AS fig, epoch_us(ts) // 1000 AS ft FROM events WHERE event_type = 'purchase')
    SELECT event_id, fig, greatest(t - ft, ft - t - 60000, 0) AS distance FROM s JOIN f USING (user_id) WHERE greatest(t - ft, ft - t - 60000, 0) <= 3600000""",
)
def jon8(spark, d):
    """Points within an hour of a one-minute span of the same user.

    Time is cut into two-hour buckets; a point looks into all that its two hours
    and a minute reach, three at most, and each pair meets in the bucket of its
    span: an equi-join on (user, bucket).
    """
    e = table(spark, d, "events").withColumn("t", F.unix_millis(F.col("ts").cast("timestamp")))
    hour = 3_600_000
    s = e.where("event_type = 'error'").select("user_id", "event_id", "t")
    s = s.withColumn("bucket", F.explode(F.sequence(F.floor((F.col("t") - hour) / (2 * hour)), F.floor((F.col("t") + hour + 60000) / (2 * hour)))))
    f = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("fig"), F.col("t").alias("ft")).withColumn("bucket", F.floor(F.col("ft") / (2 * hour)))
    distance = F.greatest(F.col("t") - F.col("ft"), F.col("ft") - F.col("t") - 60000, F.lit(0))
    return s.join(f, ["user_id", "bucket"]).withColumn("distance", distance).where(F.col("distance") <= hour).select("event_id", "fig", "distance")


@query(
    "jon9_asof_page",
    """SELECT e.event_id, p.value AS page FROM events e ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2) p
    ON e.user_id = p.user_id AND e.ts >= p.ts WHERE e.event_type = 'purchase'""",
)
def jon9(spark, d):
    e = table(spark, d, "events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return ordered.asof(left, e.where("event_type = 'view'"), ["user_id"], "ts", "ts", "value", out="page").select("event_id", "page")


@query(
    "jon10_asof_heading",
    f"""WITH {MARKED_SQL} SELECT doc_id, idx, last_value(CASE WHEN name IN ('title', 'license') THEN text END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM marked""",
)
def jon10(spark, d):
    """The latest heading of either source strictly before a line."""
    m = marked(spark, d)
    return ordered.asof(m.select("doc_id", "idx"), m.where("name in ('title', 'license')"), ["doc_id"], "idx", "idx", "text", strict=True, out="heading").select("doc_id", "idx", "heading")


@query("jon11_carried_title", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN left(text, 20) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS title FROM conversations")
def jon11(spark, d):
    title = ordered.carried(F.when(F.col("role") == "user", F.substring("text", 1, 20)), ["conv_id"], ["turn"])
    return table(spark, d, "conversations").select("conv_id", "turn", title.alias("title"))


@query(
    "jon12_asof_both_sides",
    """SELECT event_id, last_value(CASE WHEN event_type = 'search' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before,
    first_value(CASE WHEN event_type = 'search' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS after FROM events""",
)
def jon12(spark, d):
    """The nearest span before and after; the look-ahead runs as a look-back over the reverse order."""
    span = F.when(F.col("event_type") == "search", F.col("event_id"))
    before = ordered.carried(span, ["user_id"], ["ts", "event_id"], current=False)
    after = ordered.carried(span, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], current=False)
    return table(spark, d, "events").select("event_id", before.alias("before"), after.alias("after"))


#: A document has fewer lines than this.
MOST_LINES = 1 << 25


def _exts(spark, d):
    """Distinct document lines, numbered by (doc, line)."""
    at = F.col("doc_id") * MOST_LINES + F.col("idx")
    return lines(spark, d).groupBy("text").agg(F.min(at).alias("line_id"))


_SIM_SQL = f"""{LINES_SQL}, one AS (SELECT text, min(doc_id * 33554432 + idx) AS line_id FROM lines GROUP BY text),
    a AS (SELECT item_id, len(g) AS n, unnest(g) AS gram FROM (SELECT item_id, {GRAMS_SQL} AS g FROM (SELECT item_id, text AS s FROM benchmark))),
    b AS (SELECT line_id, len(g) AS m, unnest(g) AS gram FROM (SELECT line_id, {GRAMS_SQL} AS g FROM (SELECT line_id, text AS s FROM one))),
    p AS (SELECT item_id, line_id, n, m, count(*) AS inter FROM a JOIN b USING (gram) GROUP BY ALL)"""


def _pairs(spark, d, keep):
    most = lambda: table(spark, d, "documents").agg(F.sum(F.length("text"))).first()[0]
    return similarity.overlaps(table(spark, d, "benchmark").select("item_id", "text"), _exts(spark, d), ["item_id"], ["line_id"], keep=keep, most=most)


@query("jon13_jaccard_pairs", f"WITH {_SIM_SQL} SELECT item_id, line_id, inter, round(inter / (n + m - inter), 6) AS jaccard FROM p WHERE inter * 100 >= 35 * (n + m - inter)")
def jon13(spark, d):
    near = _pairs(spark, d, lambda inter, a, b: inter * 100 >= 35 * (a + b - inter))
    return near.select("item_id", "line_id", "inter", F.round("jaccard", 6).alias("jaccard"))


@query("jon14_containment_pairs", f"WITH {_SIM_SQL} SELECT item_id, line_id, inter FROM p WHERE inter >= 10 AND inter * 10 >= 6 * least(n, m)")
def jon14(spark, d):
    near = _pairs(spark, d, lambda inter, a, b: (inter >= 10) & ((inter * 10 >= 6 * a) | (inter * 10 >= 6 * b)))
    return near.select("item_id", "line_id", "inter")


@query(
    "jon15_best_match",
    f"WITH {_SIM_SQL}, r AS (SELECT *, inter / (n + m - inter) AS j, row_number() OVER (PARTITION BY item_id ORDER BY inter / (n + m - inter) DESC, line_id) AS k FROM p WHERE inter / (n + m - inter) >= 0.18) SELECT b.item_id, r.line_id, round(r.j, 6) AS jaccard FROM benchmark b LEFT JOIN r ON r.item_id = b.item_id AND r.k = 1",
)
def jon15(spark, d):
    """The best line of each item, null if none is near enough."""
    best = similarity.best_match(_pairs(spark, d, lambda inter, a, b: inter / (a + b - inter) >= 0.18), ["item_id"], "jaccard", "line_id", 0.18)
    return table(spark, d, "benchmark").select("item_id").join(best, "item_id", "left").select("item_id", "line_id", F.round("jaccard", 6).alias("jaccard"))


@query("jon16_best_containment", f"WITH {_SIM_SQL} SELECT item_id, coalesce(max(inter * 100 // n) >= 55, FALSE) AS positive FROM benchmark LEFT JOIN p USING (item_id) GROUP BY item_id")
def jon16(spark, d):
    """An item is positive if a line holds enough of it."""
    held = _pairs(spark, d, lambda inter, a, b: inter * 100 >= 55 * a).select("item_id").distinct().withColumn("held", F.lit(True))
    return table(spark, d, "benchmark").select("item_id").join(held, "item_id", "left").select("item_id", F.coalesce("held", F.lit(False)).alias("positive"))


@query(
    "jon17_owner_of_line",
    f"""WITH {MARKED_SQL}, s AS (SELECT doc_id, idx, sum(CASE WHEN name IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY idx) AS owner FROM marked)
    SELECT doc_id, idx, CAST(owner AS BIGINT) AS owner FROM s WHERE owner > 0""",
)
def jon17(spark, d):
    """The segment that owns each line."""
    return marked(spark, d).select("doc_id", "idx", ordered.run_id(F.col("name").isNotNull(), ["doc_id"], ["idx"]).alias("owner")).where("owner > 0")


@query("jon18_dangling", "SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def jon18(spark, d):
    defined = table(spark, d, "documents").where("lang = 'en'").select("doc_id")
    return table(spark, d, "labels").join(defined, "doc_id", "left_anti").select("doc_id").distinct()


@query("jon19_stem_join", "SELECT page_id, doc_id FROM (SELECT page_id, regexp_extract(lower(url), '/([0-9]+)(?:[?#].*)?$', 1) AS stem FROM pages) p JOIN documents ON stem = CAST(doc_id AS VARCHAR)")
def jon19(spark, d):
    p = table(spark, d, "pages").select("page_id", F.regexp_extract(F.lower("url"), r"/([0-9]+)(?:[?#].*)?$", 1).alias("stem"))
    return p.join(table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("stem")), "stem").select("page_id", "doc_id")


#: Turns in order, each with the n-gram sets kept so far.
_KEPT_SQL = f"""RECURSIVE t AS (SELECT conv_id, turn AS idx, {GRAMS_SQL} AS g, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM (SELECT conv_id, turn, text AS s FROM conversations)),
    r AS (SELECT conv_id, idx, k, [g] AS sets, TRUE AS kept FROM t WHERE k = 1
    UNION ALL SELECT conv_id, idx, k, CASE WHEN ok THEN list_append(sets, g) ELSE sets END, ok FROM (
        SELECT t.*, r.sets, len(list_filter(r.sets, lambda x: len(x) > 0 AND len(t.g) > 0 AND len(list_intersect(x, t.g)) >= CAST(0.85 AS DOUBLE) * least(len(x), len(t.g)))) = 0 AS ok
        FROM r JOIN t ON t.conv_id = r.conv_id AND t.k = r.k + 1))"""


@query("jon20_kept_first", f"WITH {_KEPT_SQL} SELECT conv_id, idx FROM r WHERE kept")
def jon20(spark, d):
    """Greedy removal of turns contained in an earlier kept turn of their conversation."""
    c = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("idx"), X.grams("text").alias("grams"))
    return matching.first_kept(c, "conv_id").where("kept").select("conv_id", "idx")


@query("mtc5_first_kept", f"WITH {_KEPT_SQL} SELECT conv_id, idx, kept FROM r")
def mtc5(spark, d):
    """Each turn of a conversation with whether it is kept: not contained in an earlier kept one."""
    c = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("idx"), X.grams("text").alias("grams"))
    return matching.first_kept(c, "conv_id")


@query(
    "jon21_uncovered_cells",
    """WITH c AS (SELECT DISTINCT user_id AS page, hour(ts) AS cx, CAST(floor(value / 4) AS BIGINT) AS cy FROM events WHERE event_type <> 'view'),
    b AS (SELECT user_id AS page, min(hour(ts)) AS x0, max(hour(ts)) AS x1, CAST(floor(min(value) / 4) AS BIGINT) AS y0, CAST(floor(max(value) / 8) AS BIGINT) AS y1 FROM events WHERE event_type = 'view' GROUP BY 1)
    SELECT page, CAST(cx AS BIGINT) AS cx, cy FROM c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.page = c.page AND cx BETWEEN x0 AND x1 AND cy BETWEEN y0 AND y1)""",
)
def jon21(spark, d):
    """Cells that no box of their page overlaps: the anti-join is keyed by the page."""
    return _free_cells(spark, d, F.col("user_id"))


def _free_cells(spark, d, page):
    e = table(spark, d, "events").withColumn("h", F.hour("ts"))
    cells = e.where("event_type != 'view'").select(page.alias("page"), F.col("h").cast("long").alias("cx"), F.floor(F.col("value") / 4).alias("cy")).distinct()
    box = e.where("event_type = 'view'").groupBy(page.alias("bp")).agg(F.min("h").alias("x0"), F.max("h").alias("x1"), F.floor(F.min("value") / 4).alias("y0"), F.floor(F.max("value") / 8).alias("y1"))
    hit = (F.col("page") == F.col("bp")) & F.col("cx").between(F.col("x0"), F.col("x1")) & F.col("cy").between(F.col("y0"), F.col("y1"))
    return cells.join(box, hit, "left_anti")


def _turns(spark, d, role):
    """A role's turns in lower case, numbered within the conversation."""
    c = table(spark, d, "conversations").where(F.col("role") == role)
    return c.select("conv_id", F.col("turn").alias("idx"), F.lower("text").alias("text"))


@query("mtc1_aligned")
def mtc1(spark, d):
    """User turns against assistant turns of a conversation: order-preserving pairs, then rescued ones."""
    return matching.aligned(_turns(spark, d, "user"), _turns(spark, d, "assistant"), "conv_id").withColumn("sim", F.round("sim", 6))


#: A document's pairs one after the other by ref and ext, each with the best chain that it ends.
_CHAIN_SQL = f"""RECURSIVE {LINES_SQL}, g AS (SELECT doc_id, idx, {GRAMS_SQL} AS g FROM (SELECT doc_id, idx, lower(text) AS s FROM lines)),
    e AS (SELECT doc_id, idx, len(g) AS n, unnest(g) AS gram FROM g),
    p AS (SELECT a.doc_id, a.idx AS i, b.idx AS j, count(*) AS inter, a.n + b.n AS n FROM e a JOIN e b ON a.doc_id = b.doc_id AND a.gram = b.gram AND a.idx % 2 = 1 AND b.idx % 2 = 0 GROUP BY ALL),
    q AS (SELECT doc_id, i, j, inter / (n - inter) AS s, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS k FROM p WHERE inter / (n - inter) >= CAST(0.35 AS DOUBLE)),
    best AS (SELECT doc_id, k, [{{'sum': s, 'i': -i, 'j': -j, 'path': [{{'i': i, 'j': j, 's': s}}]}}] AS ends FROM q WHERE k = 1
    UNION ALL SELECT doc_id, k, list_append(ends, {{'sum': coalesce(top['sum'], CAST(0 AS DOUBLE)) + s, 'i': -i, 'j': -j, 'path': list_append(coalesce(top['path'], []), {{'i': i, 'j': j, 's': s}})}}) FROM (
        SELECT q.*, best.ends, list_sort(list_filter(best.ends, lambda x: -x['i'] < q.i AND -x['j'] < q.j), 'DESC')[1] AS top
        FROM best JOIN q ON q.doc_id = best.doc_id AND q.k = best.k + 1))"""


@query(
    "mtc1_ordered_pairs",
    f"""WITH {_CHAIN_SQL}, whole AS (SELECT doc_id, unnest(list_sort(ends, 'DESC')[1]['path']) AS x FROM best QUALIFY k = max(k) OVER (PARTITION BY doc_id))
    SELECT doc_id, x['i'] AS ref_idx, x['j'] AS ext_idx, round(x['s'], 6) AS sim FROM whole""",
)
def mtc1_ordered(spark, d):
    """A document's odd lines against its even ones: the heaviest order-preserving pairs, without rescue."""
    g = lines(spark, d).select("doc_id", "idx", F.lower("text").alias("text"))
    found = matching.aligned(g.where("idx % 2 = 1"), g.where("idx % 2 = 0"), "doc_id")
    return found.where("how = 'order'").select("doc_id", "ref_idx", "ext_idx", F.round("sim", 6).alias("sim"))


@query("mtc2_rescued")
def mtc2(spark, d):
    """The pairs that only rescue found: by similarity out of order, by place, or by containment."""
    return mtc1(spark, d).where("how != 'order'")


@query("mtc3_overlap")
def mtc3(spark, d):
    """Matched-block recall and precision of neighbouring turns."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "text")
    nxt = F.lead("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    pairs = c.withColumn("next", nxt).where("next is not null")
    return matching.overlap(pairs, "text", "next").select("conv_id", "turn", F.round("recall", 6).alias("recall"), F.round("precision", 6).alias("precision"))


@query(
    "mtc4_figure_owners",
    """WITH s AS (SELECT user_id, event_id AS p, epoch_us(ts) // 1000 AS t FROM events WHERE event_type = 'error'), f AS (SELECT user_id, event_id AS fig, epoch_us(ts) // 1000 AS ft FROM events WHERE event_type = 'purchase'),
    near AS (SELECT p, fig, abs(t - ft) AS dist FROM s JOIN f USING (user_id) WHERE abs(t - ft) <= 3600000),
    one AS (SELECT p, fig FROM near QUALIFY row_number() OVER (PARTITION BY fig ORDER BY p) = 1),
    two AS (SELECT p, fig FROM near WHERE dist <= 1800000 AND p NOT IN (SELECT p FROM one) QUALIFY row_number() OVER (PARTITION BY fig ORDER BY p) <= 1)
    SELECT p, fig, 1 AS pass FROM one UNION ALL SELECT p, fig, 2 AS pass FROM two""",
)
def mtc4(spark, d):
    """Two passes: each figure goes to the first span near it; spans without one share a closer figure, two owners at most."""
    near = jon8(spark, d)
    e = table(spark, d, "events").select("event_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("t"))
    near = near.join(e, "event_id").join(e.toDF("fig", "ft"), "fig").select(F.col("event_id").alias("p"), "fig", F.abs(F.col("t") - F.col("ft")).alias("dist")).where("dist <= 3600000")
    first = Window.partitionBy("fig").orderBy("p")
    one = near.withColumn("k", F.row_number().over(first)).where("k = 1").select("p", "fig")
    rest = near.where("dist <= 1800000").join(one.select("p").distinct(), "p", "left_anti")
    two = rest.withColumn("k", F.row_number().over(first)).where("k <= 1").select("p", "fig")
    return one.withColumn("pass", F.lit(1)).union(two.withColumn("pass", F.lit(2)))


#: A feed row by row: for each number the best chain that ends in it, and the best chain so far.
_RISING_SQL = """RECURSIVE e AS (SELECT user_id, event_id AS idx, CAST(floor(value) AS BIGINT) AS num, CASE WHEN floor(value) = floor(value + 0.5) THEN 1.5 ELSE 1.0 END AS own, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS k FROM events),
    r AS (SELECT user_id, k, [{'score': CAST(own AS DOUBLE), 'pos': -k, 'num': num, 'path': [{'idx': idx, 'num': num}]}] AS latest, {'score': CAST(own AS DOUBLE), 'pos': -k, 'num': num, 'path': [{'idx': idx, 'num': num}]} AS best FROM e WHERE k = 1
    UNION ALL SELECT user_id, k, CASE WHEN old IS NULL THEN list_append(latest, made) WHEN made['score'] > old['score'] THEN list_append(list_filter(latest, lambda x: x['num'] <> num), made) ELSE latest END,
        CASE WHEN made['score'] > best['score'] THEN made ELSE best END FROM (
        SELECT *, {'score': CAST(own + coalesce(prev['score'], 0) AS DOUBLE), 'pos': -k, 'num': num, 'path': list_append(coalesce(prev['path'], []), {'idx': idx, 'num': num})} AS made FROM (
            SELECT e.*, r.latest, r.best, list_filter(r.latest, lambda x: x['num'] = e.num)[1] AS old, list_sort(list_filter(r.latest, lambda x: x['num'] BETWEEN e.num - 3 AND e.num - 1), 'DESC')[1] AS prev
            FROM r JOIN e ON e.user_id = r.user_id AND e.k = r.k + 1)))"""


@query(
    "mtc6_chain",
    f"""WITH {_RISING_SQL}, whole AS (SELECT user_id, unnest(best['path']) AS x FROM r QUALIFY k = max(k) OVER (PARTITION BY user_id)) SELECT user_id, x['idx'] AS idx, x['num'] AS num FROM whole""",
)
def mtc6(spark, d):
    """The best rising chain of numbers within a feed."""
    e = table(spark, d, "events").select("user_id", F.col("event_id").alias("idx"), F.floor("value").alias("num"), F.floor(F.col("value") + 0.5).alias("shown"))
    return matching.chains(e, "user_id", 3)


@query(
    "mtc7_exempt_duplicates",
    f"WITH {_SIM_SQL} SELECT DISTINCT line_id FROM p WHERE inter / (n + m - inter) >= 0.6 OR (inter >= 10 AND inter / least(n, m) >= 0.6)",
)
def mtc7(spark, d):
    alike = lambda inter, a, b: (inter / (a + b - inter) >= 0.6) | ((inter >= 10) & ((inter / a >= 0.6) | (inter / b >= 0.6)))
    return _pairs(spark, d, alike).select("line_id").distinct()


#: The free cells of a page, each with the least cell that it reaches.
_BLOB_SQL = """RECURSIVE c AS (SELECT DISTINCT user_id AS page, hour(ts) AS cx, CAST(floor(value / 4) AS BIGINT) AS cy FROM events WHERE event_type <> 'view'),
    b AS (SELECT user_id AS page, min(hour(ts)) AS x0, max(hour(ts)) AS x1, CAST(floor(min(value) / 4) AS BIGINT) AS y0, CAST(floor(max(value) / 8) AS BIGINT) AS y1 FROM events WHERE event_type = 'view' GROUP BY 1),
    free AS (SELECT page, CAST(cx AS BIGINT) AS cx, cy FROM c WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.page = c.page AND cx BETWEEN x0 AND x1 AND cy BETWEEN y0 AND y1)),
    reach AS (SELECT page, cx, cy, cx AS rx, cy AS ry FROM free
    UNION SELECT r.page, r.cx, r.cy, f.cx, f.cy FROM reach r JOIN free f ON f.page = r.page AND abs(f.cx - r.rx) <= 1 AND abs(f.cy - r.ry) <= 1),
    root AS (SELECT page, cx, cy, min(rx * 1000000 + ry) AS root FROM reach GROUP BY ALL)"""


@query(
    "mtc8_blobs",
    f"""WITH {_BLOB_SQL}
    SELECT page, dense_rank() OVER (PARTITION BY page ORDER BY root) - 1 AS blob, count(*) AS cells, min(cx) AS x0, min(cy) AS y0, max(cx) AS x1, max(cy) AS y1 FROM root GROUP BY page, root""",
)
def mtc8(spark, d):
    """Connected cells of each page, with their boxes."""
    return blobs.blobs(jon21(spark, d), "page")


@query(
    "mtc8_large_blobs",
    f"""WITH {_BLOB_SQL.replace("user_id AS page", "user_id % 5 AS page")}, whole AS (SELECT page, root, count(*) AS cells, min(cx) AS x0, min(cy) AS y0, max(cx) AS x1, max(cy) AS y1 FROM root GROUP BY page, root)
    SELECT page, row_number() OVER (PARTITION BY page ORDER BY root) - 1 AS blob, * EXCLUDE (page, root) FROM whole WHERE cells >= 12 AND (x1 - x0 + 1) * (y1 - y0 + 1) * 40 * 40 >= 120 * 120""",
)
def mtc8_large(spark, d):
    """Suspicious regions: blobs of at least 12 cells (of side 40) and an area of 120 x 120; the cells of many users to a page."""
    return blobs.blobs(_free_cells(spark, d, F.col("user_id") % 5), "page", 12, 40, 120 * 120)


@query(
    "win10_repaired_numbers",
    """WITH RECURSIVE e AS (SELECT user_id, event_type, event_id AS idx, CAST(floor(value) AS BIGINT) || CAST(event_id % 10 AS VARCHAR) AS raw,
        row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events),
    r AS (SELECT user_id, event_type, idx, k, CAST(raw AS BIGINT) AS num, FALSE AS num_fixed FROM e WHERE k = 1
    UNION ALL SELECT user_id, event_type, idx, k, CASE WHEN cut THEN want ELSE whole END, cut FROM (
        SELECT e.*, r.num + 1 AS want, CAST(e.raw AS BIGINT) AS whole,
            starts_with(e.raw, CAST(r.num + 1 AS VARCHAR)) AND length(e.raw) > length(CAST(r.num + 1 AS VARCHAR)) AS cut
        FROM r JOIN e ON e.user_id = r.user_id AND e.event_type = r.event_type AND e.k = r.k + 1))
    SELECT user_id, idx, num, num_fixed FROM r""",
)
def win10(spark, d):
    """Numbers read together with the text that follows, cut so that they continue their chain."""
    raw = F.concat(F.floor("value").cast("string"), (F.col("event_id") % 10).cast("string"))
    return matching.repaired(table(spark, d, "events").select("user_id", F.col("event_id").alias("idx"), F.col("event_type").alias("name"), raw.alias("raw")), "user_id")
