"""Queries for scans, projections and filters (SRC, PRJ, FLT)."""

from __future__ import annotations

from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import matching, ordered
from linefold.plans.markers_sql import MARKED_SQL
from linefold.plans.registry import query
from linefold.sources.tables import LINES_SQL, lines, table

PAGE_JSON = "array<struct<page: long, lines: array<struct<text: string>>>>"


@query(
    "src1_nested_pages",
    """SELECT conv_id, turn AS page, i AS line, parts[i] AS text
    FROM (SELECT conv_id, turn, string_split(text, chr(10)) AS parts FROM conversations), unnest(range(1, len(parts) + 1)) AS u(i)""",
)
def src1(spark, d):
    """Pages of lines nested in JSON, flattened with the page's place carried to each line."""
    turns = table(spark, d, "conversations")
    page = F.struct(F.col("turn").alias("page"), F.transform(F.split("text", "\n", -1), lambda x: F.struct(x.alias("text"))).alias("lines"))
    nested = turns.groupBy("conv_id").agg(F.to_json(F.collect_list(page)).alias("body"))
    pages = nested.select("conv_id", F.explode(F.from_json("body", PAGE_JSON)).alias("p"))
    return pages.select("conv_id", F.col("p.page").alias("page"), F.posexplode("p.lines").alias("pos", "l")).select("conv_id", "page", (F.col("pos") + 1).cast("long").alias("line"), F.col("l.text").alias("text"))


@query("src2_lines_with_width", f"WITH {LINES_SQL} SELECT doc_id, idx, length(text) AS width, max(length(text)) OVER (PARTITION BY doc_id) AS doc_width FROM lines")
def src2(spark, d):
    """Lines with their width and the document's largest, taken before the explode: no shuffle."""
    docs = table(spark, d, "documents").where("text is not null").withColumn("parts", F.split("text", "\n", -1))
    docs = docs.withColumn("doc_width", F.array_max(F.transform("parts", lambda x: F.length(x))).cast("long"))
    return docs.select("doc_id", "doc_width", F.posexplode("parts").alias("pos", "t")).select("doc_id", (F.col("pos") + 1).cast("long").alias("idx"), F.length("t").cast("long").alias("width"), "doc_width")


@query("src3_run_filter", "SELECT doc_id, source FROM documents WHERE contains(source, '1') OR contains(source, '7')")
def src3(spark, d):
    wanted = F.array(F.lit("1"), F.lit("7"))
    return table(spark, d, "documents").where(F.exists(wanted, lambda f: F.contains(F.col("source"), f))).select("doc_id", "source")


@query("src4_list_runs", "SELECT DISTINCT source FROM documents WHERE text IS NOT NULL")
def src4(spark, d):
    return table(spark, d, "documents").where("text is not null").select("source").distinct()


@query(
    "src6_coalesced_fields",
    """SELECT event_id, CAST(coalesce(json_extract_string(props, '$.region.x'), json_extract_string(props, '$.x'), json_extract_string(props, '$.k')) AS BIGINT) AS x
    FROM events""",
)
def src6(spark, d):
    """A coordinate under any of its spellings."""
    names = ["$.region.x", "$.x", "$.k"]
    return table(spark, d, "events").select("event_id", F.coalesce(*[F.get_json_object("props", n) for n in names]).try_cast("long").alias("x"))


@query("src7_kept_lines", rf"WITH {LINES_SQL} SELECT doc_id, idx, text FROM lines WHERE trim(text) <> '' AND NOT regexp_matches(text, '^[- ]*[0-9]+[- ]*$')")
def src7(spark, d):
    return lines(spark, d).where((F.trim("text") != "") & ~F.col("text").rlike(r"^[- ]*[0-9]+[- ]*$"))


@query(
    "src8_sniffed_kinds",
    """SELECT CASE WHEN html[1:9] = '<!DOCTYPE' THEN 'html' WHEN html[1:4] = '%PDF' THEN 'pdf' WHEN html[1:1] = '{' THEN 'json' ELSE 'unknown' END AS kind,
    count(*) AS n, CAST(sum(length(html)) AS BIGINT) AS chars FROM pages GROUP BY 1""",
)
def src8(spark, d):
    """Kinds by magic bytes."""
    head = F.encode(F.substring("html", 1, 16), "utf-8")
    kind = F.when(F.substring(head, 1, 9) == F.lit(b"<!DOCTYPE"), "html").when(F.substring(head, 1, 4) == F.lit(b"%PDF"), "pdf").when(F.substring(head, 1, 1) == F.lit(b"{"), "json").otherwise("unknown")
    return table(spark, d, "pages").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.sum(F.length("html")).alias("chars"))


@query(
    "src9_path_parts",
    r"""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1) AS path,
    regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS name FROM pages""",
)
def src9(spark, d):
    return table(spark, d, "pages").select(
        "page_id",
        F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1).alias("host"),
        F.regexp_extract("url", r"^[a-z]+://[^/?#]+([^?#]*)", 1).alias("path"),
        F.regexp_extract("url", r"([^/?#]*)(?:[?#].*)?$", 1).alias("name"),
    )


@query("src10_last_record", "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def src10(spark, d):
    """The last record of each tag: one aggregation, no sort."""
    last = F.max(F.struct("event_id", "event_type", "value")).alias("x")
    return table(spark, d, "events").groupBy("user_id").agg(last).select("user_id", "x.*")


@query("prj1_text_of", rf"WITH {LINES_SQL} SELECT doc_id, idx, regexp_replace(coalesce(nullif(text, ''), ''), '^[\t-\r ]+|[\t-\r ]+$', '', 'g') AS text FROM lines")
def prj1(spark, d):
    return lines(spark, d).select("doc_id", "idx", X.first_text("text").alias("text"))


@query("prj2_truthy_width", "SELECT doc_id, coalesce(nullif(n_chars % 7, 0), nullif(n_chars % 5, 0), n_chars) AS width FROM documents")
def prj2(spark, d):
    n = F.col("n_chars")
    return table(spark, d, "documents").select("doc_id", F.coalesce(F.nullif(n % 7, F.lit(0)), F.nullif(n % 5, F.lit(0)), n).alias("width"))


#: Line markers of the synthetic texts: name, pattern, kind.
MARKERS = [
    ("license", r"^\s*(?:Licensed|Released|This work)\b", "notice"),
    ("shout", r"^\s*([A-Z]{2,})!!", "noise"),
    ("list", r"^\s*(\w+)\s\|", "table"),
    ("number", r"^\s*([0-9]{1,4})\b", "item"),
    ("title", r"^\s*([A-Z][a-z]+)\.\s*$", "head"),
]
def marked(spark, d):
    return lines(spark, d).withColumn("m", X.match_marker("text", MARKERS)).select("doc_id", "idx", "text", F.col("m.name").alias("name"), F.col("m.raw").alias("raw"), F.col("m.kind").alias("kind"))


@query("prj3_first_marker", f"WITH {MARKED_SQL} SELECT doc_id, idx, name FROM marked WHERE name IS NOT NULL")
def prj3(spark, d):
    """The first pattern of an ordered table that a line begins with."""
    return marked(spark, d).where("name is not null").select("doc_id", "idx", "name")


@query("prj4_display_name", "SELECT event_id, CASE event_type WHEN 'click' THEN 'tap' WHEN 'error' THEN 'fault' ELSE event_type END AS shown FROM events")
def prj4(spark, d):
    names = F.create_map(F.lit("click"), F.lit("tap"), F.lit("error"), F.lit("fault"))
    return table(spark, d, "events").select("event_id", F.coalesce(names[F.col("event_type")], "event_type").alias("shown"))


@query(
    "prj5_line_classes",
    rf"WITH {LINES_SQL} SELECT doc_id, idx, trim(text) = '' AS is_blank, contains(text, ' | ') AS is_table, regexp_matches(text, '^[^a-z]*[A-Z][^a-z]*$') AS is_shout FROM lines",
)
def prj5(spark, d):
    t = F.col("text")
    return lines(spark, d).select("doc_id", "idx", (F.trim(t) == "").alias("is_blank"), F.contains(t, F.lit(" | ")).alias("is_table"), t.rlike("^[^a-z]*[A-Z][^a-z]*$").alias("is_shout"))


@query("prj6_gap", "SELECT event_id, epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS gap_us FROM events")
def prj6(spark, d):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("event_id", ordered.gap_to_previous(at, ["user_id"], ["ts", "event_id"]).alias("gap_us"))


@query(
    "prj7_stripped_marker",
    rf"""WITH {MARKED_SQL} SELECT doc_id, idx, CASE name WHEN 'license' THEN regexp_replace(text, '^\s*(?:Licensed|Released|This work)\b', '')
    WHEN 'shout' THEN regexp_replace(text, '^\s*([A-Z]{{2,}})!!', '') WHEN 'list' THEN regexp_replace(text, '^\s*(\w+)\s\|', '')
    WHEN 'number' THEN regexp_replace(text, '^\s*([0-9]{{1,4}})\b', '') WHEN 'title' THEN regexp_replace(text, '^\s*([A-Z][a-z]+)\.\s*$', '') END AS rest
    FROM marked WHERE name IS NOT NULL""",
)
def prj7(spark, d):
    return marked(spark, d).where("name is not null").select("doc_id", "idx", X.strip_marker("text", MARKERS).alias("rest"))


@query("prj8_skeleton", "SELECT item_id, replace(array_to_string(regexp_extract_all(lower(text), '[a-z]+'), ''), 'ing', 'in') AS skeleton FROM benchmark")
def prj8(spark, d):
    """Letters only, with one ending made equal."""
    return table(spark, d, "benchmark").select("item_id", F.replace(X.keep_only(F.lower("text"), "[a-z]+"), F.lit("ing"), F.lit("in")).alias("skeleton"))


GRAMS_SQL = "list_distinct(list_transform(range(1, greatest(length(s) - 2, 1) + 1), lambda i: s[i:i + 2]))"


@query("prj9_grams", f"SELECT item_id, CAST(len(g) AS BIGINT) AS n_grams, list_min(g) AS least FROM (SELECT item_id, {GRAMS_SQL} AS g FROM (SELECT item_id, text AS s FROM benchmark))")
def prj9(spark, d):
    g = table(spark, d, "benchmark").select("item_id", X.grams("text").alias("g"))
    return g.select("item_id", F.size("g").cast("long").alias("n_grams"), F.array_min("g").alias("least"))


@query("prj10_masked_digits", rf"WITH {LINES_SQL} SELECT doc_id, idx, regexp_replace(text, '[0-9]+', '#', 'g') AS masked FROM lines WHERE regexp_matches(text, '[0-9]')")
def prj10(spark, d):
    return lines(spark, d).where(F.col("text").rlike("[0-9]")).select("doc_id", "idx", X.mask_digits("text").alias("masked"))


@query(
    "prj11_scrubbed",
    r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(text, '[#$%&*|]+', '', 'g'), '!!+', '!', 'g'), '[ ]+', ' ', 'g') AS clean FROM documents""",
)
def prj11(spark, d):
    return table(spark, d, "documents").select("doc_id", X.scrub(F.col("text"), [("[#$%&*|]+", ""), ("!!+", "!"), ("[ ]+", " ")]).alias("clean"))


@query("prj12_numbers", r"SELECT doc_id, CAST(nullif(regexp_extract(text, '\b([0-9]{1,9})\b', 1), '') AS BIGINT) AS num FROM documents WHERE regexp_matches(text, '\b[0-9]{1,9}\b')")
def prj12(spark, d):
    t = table(spark, d, "documents").where(F.col("text").rlike(r"\b[0-9]{1,9}\b"))
    return t.select("doc_id", F.nullif(F.regexp_extract("text", r"\b([0-9]{1,9})\b", 1), F.lit("")).cast("long").alias("num"))


@query("prj13_paragraph", "SELECT conv_id, left(string_agg(text, chr(10) ORDER BY turn), 700) AS paragraph FROM conversations GROUP BY conv_id")
def prj13(spark, d):
    """Texts of a group in order, cut to 700 characters."""
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.substring(X.ordered_concat(["turn"], "text", "\n"), 1, 700).alias("paragraph"))


@query("prj14_ratio", "SELECT l_orderkey, l_linenumber, CAST(floor(l_extendedprice * 254 / l_quantity) AS BIGINT) AS tenths FROM lineitem")
def prj14(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.floor(F.col("l_extendedprice") * 254 / F.col("l_quantity")).alias("tenths"))


@query("prj15_content_hash", "SELECT doc_id, sha256(text) AS digest FROM documents")
def prj15(spark, d):
    return table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))


@query("prj16_page_range", "SELECT conv_id, turn, role FROM conversations WHERE turn BETWEEN 1 AND 2 OR turn IN (5)")
def prj16(spark, d):
    """A range literal such as "1-2,5" as a predicate that reaches the scan."""
    keep = F.lit(False)
    for part in "1-2,5".split(","):
        lo, _, hi = part.partition("-")
        keep = keep | F.col("turn").between(int(lo), int(hi or lo))
    return table(spark, d, "conversations").where(keep).select("conv_id", "turn", "role")


@query("prj17_narrow", "SELECT doc_id, lang, left(text, 90) AS head, CAST(length(text) AS BIGINT) AS chars FROM documents")
def prj17(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang", F.substring("text", 1, 90).alias("head"), F.length("text").cast("long").alias("chars"))


@query(
    "prj18_segments",
    r"""SELECT page_id, i AS seq, CASE WHEN s[i][1:1] = '<' THEN 'tag' ELSE 'text' END AS kind, s[i] AS part
    FROM (SELECT page_id, regexp_extract_all(html, '<[^>]*>|[^<]+') AS s FROM pages), unnest(range(1, len(s) + 1)) AS u(i)""",
)
def prj18(spark, d):
    """A markup text as typed segments in order."""
    p = table(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit("(<[^>]*>|[^<]+)"), F.lit(1))).alias("pos", "part"))
    return p.select("page_id", (F.col("pos") + 1).cast("long").alias("seq"), F.when(F.startswith("part", F.lit("<")), "tag").otherwise("text").alias("kind"), "part")


@query(
    "prj19_urls",
    """SELECT page_id, i AS seq, u[i] AS url FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS u FROM pages), unnest(range(1, len(u) + 1)) AS x(i)""",
)
def prj19(spark, d):
    p = table(spark, d, "pages").select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("pos", "url"))
    return p.select("page_id", (F.col("pos") + 1).cast("long").alias("seq"), "url")


@query("flt1_dropped_types", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error') AND value IS DISTINCT FROM 0")
def flt1(spark, d):
    return table(spark, d, "events").where(~F.col("event_type").isin("error") & ~F.col("value").eqNullSafe(0.0)).select("event_id", "event_type")


@query(
    "flt2_wide_figures",
    f"WITH {LINES_SQL} SELECT doc_id, idx, length(text) AS width FROM (SELECT *, max(length(text)) OVER (PARTITION BY doc_id) AS m FROM lines) WHERE NOT (contains(text, '|') AND length(text) * 4 > m * 3)",
)
def flt2(spark, d):
    """Drops wide tables: a line over three quarters of the document's width."""
    docs = table(spark, d, "documents").where("text is not null").withColumn("parts", F.split("text", "\n", -1))
    docs = docs.withColumn("m", F.array_max(F.transform("parts", lambda x: F.length(x))))
    one = docs.select("doc_id", "m", F.posexplode("parts").alias("pos", "text")).withColumn("width", F.length("text").cast("long"))
    return one.where(~(F.contains("text", F.lit("|")) & (F.col("width") * 4 > F.col("m") * 3))).select("doc_id", (F.col("pos") + 1).cast("long").alias("idx"), "width")


@query("flt3_type_set", "SELECT event_type, count(*) AS n FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1")
def flt3(spark, d):
    return table(spark, d, "events").where(F.col("event_type").isin("click", "view", "purchase")).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "flt4_weak_guards",
    rf"""WITH {MARKED_SQL}, g AS (SELECT *, string_agg(text, '') OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS ahead,
    coalesce(max(CASE WHEN contains(text, '|') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING), 0) AS tables FROM marked)
    SELECT doc_id, idx, name FROM g WHERE name IS NOT NULL AND (name NOT IN ('title', 'number') OR (regexp_matches(ahead, 'tion[.,]') AND tables = 0 AND NOT regexp_matches(text, '^\s*[0-9]+ (?:of|in)\b')))""",
)
def flt4(spark, d):
    """Weak markers count only with an ending within 8 lines, no table in the 3 lines before, and no false follower."""
    m = marked(spark, d)
    weak = F.col("name").isin("title", "number")
    ahead = ordered.ahead_text(F.col("text"), 8, ["doc_id"], ["idx"])
    near = ordered.any_near(F.contains("text", F.lit("|")), 3, -1, ["doc_id"], ["idx"])
    m = m.withColumn("ok", ahead.rlike("tion[.,]") & ~near & ~F.col("text").rlike(r"^\s*[0-9]+ (?:of|in)\b"))
    return m.where(F.col("name").isNotNull() & (~weak | F.col("ok"))).select("doc_id", "idx", "name")


@query(
    "flt5_not_under_head",
    """WITH e AS (SELECT event_id, event_type, value, last_value(CASE WHEN event_type = 'search' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING) AS head FROM events)
    SELECT event_id FROM e WHERE event_type = 'click' AND coalesce(head < 20, TRUE)""",
)
def flt5(spark, d):
    """Rows whose nearest head in the 40 rows before does not match."""
    head = ordered.carried(F.when(F.col("event_type") == "search", F.col("value")), ["user_id"], ["ts", "event_id"], back=40, current=False)
    e = table(spark, d, "events").withColumn("head", head)
    return e.where((F.col("event_type") == "click") & F.coalesce(F.col("head") < 20, F.lit(True))).select("event_id")


def _picked_sql(rows: str, length: str) -> str:
    """Of ``rows`` (doc_id, idx, ...), in order, those that begin when the stretch taken before has ended."""
    return f"""RECURSIVE {rows}, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY idx) AS k FROM w),
    r AS (SELECT doc_id, idx, k, {length} AS length, idx + {length} AS free, TRUE AS taken FROM o WHERE k = 1
    UNION ALL SELECT o.doc_id, o.idx, o.k, {length.replace("take", "o.take")}, CASE WHEN o.idx >= r.free THEN o.idx + {length.replace("take", "o.take")} ELSE r.free END, o.idx >= r.free
        FROM r JOIN o ON o.doc_id = r.doc_id AND o.k = r.k + 1)"""


@query("flt6_spaced_picks", f"WITH {_picked_sql(MARKED_SQL + ', w AS (SELECT doc_id, idx FROM marked WHERE name IN (' + chr(39) + 'title' + chr(39) + ', ' + chr(39) + 'list' + chr(39) + '))', '3')} SELECT doc_id, idx FROM r WHERE taken")
def flt6(spark, d):
    """Lines taken one after another, each more than 2 lines from the one taken before (order dependent)."""
    return matching.spaced(marked(spark, d), "doc_id", "name in ('title', 'list')", 2)


@query(
    "flt7_post_check",
    "SELECT conv_id FROM (SELECT conv_id, string_agg(regexp_replace(text, 'https?://\\S+', '', 'g'), '' ORDER BY turn) AS body FROM conversations GROUP BY conv_id) WHERE regexp_matches(body, '[?]|tion[.]') AND NOT contains(body, '|')",
)
def flt7(spark, d):
    body = X.ordered_concat(["turn"], F.regexp_replace("text", r"https?://\S+", ""))
    c = table(spark, d, "conversations").groupBy("conv_id").agg(body.alias("body"))
    return c.where(F.col("body").rlike("[?]|tion[.]") & ~F.contains("body", F.lit("|"))).select("conv_id")


@query("flt8_prefilter", "SELECT doc_id FROM documents WHERE NOT regexp_matches(split_part(text, chr(10), 1), '^(The|Of|And)\\b')")
def flt8(spark, d):
    """Dropped on its first line, before anything costly."""
    return table(spark, d, "documents").where(~F.split_part("text", F.lit("\n"), F.lit(1)).rlike(r"^(The|Of|And)\b")).select("doc_id")


@query("flt9_veto", "SELECT doc_id FROM documents JOIN labels USING (doc_id) WHERE quality = 1 AND NOT contains(text, '###')")
def flt9(spark, d):
    ok = table(spark, d, "labels").where("quality = 1").select("doc_id")
    return table(spark, d, "documents").where(~F.contains("text", F.lit("###"))).join(ok, "doc_id").select("doc_id")


@query(
    "flt10_inclusion_policy",
    "SELECT CASE WHEN regexp_matches(text, 'tion[.]') THEN 'kept' WHEN contains(text, 'the') THEN 'activity' ELSE 'concept' END AS policy, count(*) AS n FROM benchmark GROUP BY 1",
)
def flt10(spark, d):
    p = F.when(F.col("text").rlike("tion[.]"), "kept").when(F.contains("text", F.lit("the")), "activity").otherwise("concept")
    return table(spark, d, "benchmark").groupBy(p.alias("policy")).agg(F.count("*").alias("n"))


@query("flt11_titles", rf"WITH {LINES_SQL} SELECT doc_id, idx, text FROM lines WHERE length(text) BETWEEN 3 AND 40 AND regexp_matches(text, '^[A-Z]') AND NOT contains(text, ',') AND NOT regexp_matches(text, '[0-9|!]')")
def flt11(spark, d):
    t = F.col("text")
    return lines(spark, d).where(F.length(t).between(3, 40) & t.rlike("^[A-Z]") & ~F.contains(t, F.lit(",")) & ~t.rlike("[0-9|!]"))


@query("flt12_without_solutions", "SELECT conv_id, turn FROM conversations WHERE role <> 'system' AND NOT regexp_matches(text, '^(The|Of)\\b')")
def flt12(spark, d):
    return table(spark, d, "conversations").where((F.col("role") != "system") & ~F.col("text").rlike(r"^(The|Of)\b")).select("conv_id", "turn")


@query("flt13_low_confidence", "SELECT event_id, value FROM events WHERE value < 0.6")
def flt13(spark, d):
    return table(spark, d, "events").where("value < 0.6").select("event_id", "value")


@query("flt14_name_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring') OR contains(p_name, 'red')")
def flt14(spark, d):
    return table(spark, d, "part").where(F.contains("p_name", F.lit("ring")) | F.contains("p_name", F.lit("red"))).select("p_partkey", "p_name")


@query("flt15_candidate_lines", rf"WITH {LINES_SQL} SELECT doc_id, idx FROM lines WHERE contains(left(text, 14), 'the') OR regexp_matches(text, '^[0-9 ]+$')")
def flt15(spark, d):
    return lines(spark, d).where(F.contains(F.substring("text", 1, 14), F.lit("the")) | F.col("text").rlike("^[0-9 ]+$")).select("doc_id", "idx")


_TAKE_SQL = r"CASE WHEN regexp_matches(text, '^(The|Der|La|El)([^\pL\pN_]|$)') THEN 5 WHEN regexp_matches(text, 'tion[.]\s*$') THEN 3 END"


@query("flt16_negative_blocks", f"WITH {_picked_sql(LINES_SQL + ', w AS (SELECT doc_id, idx, take FROM (SELECT doc_id, idx, ' + _TAKE_SQL + ' AS take FROM lines) WHERE take IS NOT NULL)', 'take')} SELECT doc_id, idx, length FROM r WHERE taken")
def flt16(spark, d):
    """Blocks of lines that are no tasks: five from a head, three up to an ending, none overlapping an earlier one."""
    t = F.col("text")
    length = F.when(t.rlike("^(The|Der|La|El)\\b"), 5).when(t.rlike("tion[.]\\s*$"), 3)
    return matching.disjoint(lines(spark, d).withColumn("take", length).where("take is not null"), "doc_id", "take")
