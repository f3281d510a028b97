"""Queries for injected functions, table functions, sinks and checks (UDF, UDTF, SNK, LINT)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import boundaries, expectations, judge
from linefold.plans.registry import query
from linefold.plans.rows import marked
from linefold.session import shared_dir
from linefold.sources import sinks
from linefold.sources.tables import table


def _stub(text: str) -> bool:
    """A deterministic judge that fails on one kind of text."""
    if "###" in text:
        raise ValueError("cannot be judged")
    return "tion" in text


@query(
    "udf1_judged",
    """SELECT doc_id, CASE WHEN lang <> 'en' THEN 'not asked' WHEN contains(text, '###') THEN 'failed' WHEN contains(text, 'tion') THEN 'accepted' ELSE 'rejected' END AS status FROM documents""",
)
def udf1(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", "text")
    return judge.judged(docs, "text", _stub, F.col("lang") == "en").select("doc_id", "status")


def _names_blocks(text: str) -> str:
    """A deterministic judge: the anchor, and every shown block that holds a certain ending; it fails on one kind of text."""
    if "###" in text:
        raise ValueError("cannot be judged")
    return ", ".join(x[1 : x.index("]")] for x in text.split("\n\n") if x.startswith("[") and (boundaries.ANCHOR in x or "tion" in x))


@query("udf2_refined_boundaries")
def udf2(spark, d):
    """List entries of a document, each widened over neighbouring blocks that a judge takes for part of it."""
    m = marked(spark, d)
    before = F.length(F.lag("text").over(Window.partitionBy("doc_id").orderBy("idx")))
    rows = m.select("doc_id", "idx", "text", F.abs(F.length("text") - before).cast("double").alias("gap"), (F.coalesce("name", F.lit("")) == "title").alias("head"))
    entry = m.where("name in ('list', 'number')").select("doc_id", F.col("idx").alias("start"), F.col("idx").alias("end"), (F.col("name") == "number").alias("open"))
    return boundaries.refine(rows, entry, "doc_id", _names_blocks, 60.0)


@query("udf6_all_parts_ok", """SELECT page_id, len(list_filter(regexp_extract_all(html, '<[^>]*>'), lambda x: length(x) > 80)) = 0 AS ok FROM pages""")
def udf6(spark, d):
    tags = F.regexp_extract_all("html", F.lit("(<[^>]*>)"), F.lit(1))
    return table(spark, d, "pages").select("page_id", F.forall(tags, lambda x: F.length(x) <= 80).alias("ok"))


@query("udtf2_typed_blocks", "SELECT conv_id, turn, i AS seq, CASE WHEN i = 1 THEN 'head' ELSE 'body' END AS kind, p[i] AS text FROM (SELECT conv_id, turn, string_split(text, '. ') AS p FROM conversations), unnest(range(1, len(p) + 1)) AS u(i)")
def udtf2(spark, d):
    """One turn to many typed blocks."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.posexplode(F.split("text", r"\. ", -1)).alias("pos", "text"))
    return c.select("conv_id", "turn", (F.col("pos") + 1).cast("long").alias("seq"), F.when(F.col("pos") == 0, "head").otherwise("body").alias("kind"), "text")


@query("udtf3_answers", "SELECT conv_id, CAST(turn AS INTEGER) AS page, '\\x' || text AS text FROM conversations")
def udtf3(spark, d):
    """Fenced JSON answers with a lone back-slash, repaired and exploded."""
    item = F.struct(F.col("turn").cast("int").alias("page"), F.concat(F.lit("@@x"), "text").alias("text"))
    body = F.replace(F.to_json(F.collect_list(item)), F.lit("@@"), F.lit("\\"))
    c = table(spark, d, "conversations").groupBy("conv_id").agg(F.concat(F.lit("```json\n"), body, F.lit("\n```")).alias("answer"))
    return judge.answers(c, "answer")


@query(
    "snk1_report_sections",
    """SELECT 'languages' AS section, lang AS name, count(*) AS n FROM documents GROUP BY lang UNION ALL SELECT 'roles', role, count(*) FROM conversations GROUP BY role
    UNION ALL SELECT 'events', event_type, count(*) FROM events GROUP BY event_type""",
)
def snk1(spark, d):
    """Each section of a report is one small result; formatting it is left to the reader."""
    parts = [("languages", "documents", "lang"), ("roles", "conversations", "role"), ("events", "events", "event_type")]
    made = [table(spark, d, t).groupBy(F.col(c).alias("name")).agg(F.count("*").alias("n")).select(F.lit(s).alias("section"), "name", "n") for s, t, c in parts]
    return expectations.all_checks(made)


@query("snk3_history_last", "SELECT user_id AS tag, max(event_id) AS ord, arg_max(value, event_id) AS value FROM events GROUP BY user_id")
def snk3(spark, d):
    """Two appended runs of records, read back: the last of each tag."""
    path = shared_dir(spark, "history")
    e = table(spark, d, "events").select(F.col("user_id").alias("tag"), F.col("event_id").alias("ord"), "value")
    for part in (0, 1):
        sinks.append_history(e.where(F.col("ord") % 2 == part), path)
    return sinks.last_of_tag(spark, path, "tag long, ord long, value double", "tag", "ord")


@query("snk4_csv_round_trip", "SELECT p_partkey, p_name, p_retailprice FROM part")
def snk4(spark, d):
    path = shared_dir(spark, "csv")
    sinks.write_csv(table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), path)
    back = spark.read.option("header", True).schema("p_partkey long, p_name string, p_retailprice double").option("enforceSchema", True).csv(path)
    return back


@query(
    "snk7_html",
    """SELECT conv_id, string_agg('<p class="' || role || '">' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</p>', chr(10) ORDER BY turn) AS html FROM conversations GROUP BY conv_id""",
)
def snk7(spark, d):
    row = F.concat(F.lit('<p class="'), "role", F.lit('">'), sinks.escaped("text"), F.lit("</p>"))
    return table(spark, d, "conversations").groupBy("conv_id").agg(X.ordered_concat(["turn"], row, "\n").alias("html"))


@query(
    "snk8_failure_counts",
    "SELECT CASE WHEN n_chars < 100 THEN 'too small' WHEN contains(text, '$$$') THEN 'noisy' ELSE 'done' END AS outcome, count(*) AS n FROM documents GROUP BY 1",
)
def snk8(spark, d):
    outcome = F.when(F.col("n_chars") < 100, "too small").when(F.contains("text", F.lit("$$$")), "noisy").otherwise("done")
    return table(spark, d, "documents").groupBy(outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query(
    "lint_checks",
    """SELECT 'short text' AS "check", CAST(doc_id AS VARCHAR) AS key FROM documents WHERE length(text) < 20
    UNION ALL SELECT 'label without document', CAST(doc_id AS VARCHAR) FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
    UNION ALL SELECT 'repeated url', url FROM pages GROUP BY url HAVING count(*) > 1
    UNION ALL SELECT 'open markup', CAST(page_id AS VARCHAR) FROM pages WHERE NOT contains(html, '</html>')
    UNION ALL SELECT 'length differs', CAST(doc_id AS VARCHAR) FROM documents WHERE n_chars <> length(text)""",
)
def lint(spark, d):
    docs, labels, pages = (table(spark, d, t) for t in ("documents", "labels", "pages"))
    return expectations.all_checks(
        [
            expectations.row_check(docs, "short text", "doc_id", F.length("text") < 20),
            expectations.reference_check(labels, "label without document", "doc_id", docs, "doc_id"),
            expectations.unique_check(pages, "repeated url", "url"),
            expectations.row_check(pages, "open markup", "page_id", ~F.contains("html", F.lit("</html>"))),
            expectations.row_check(docs, "length differs", "doc_id", F.col("n_chars") != F.length("text")),
        ]
    )
