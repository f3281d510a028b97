"""Queries over zip packages, which are written from the documents and read back (SRC-8, SRC-14, LINT), and over kept results (SRC-11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import package_checks
from linefold.plans.registry import query
from linefold.session import shared_dir
from linefold.sources import packages as P
from linefold.sources import reuse
from linefold.sources.tables import table

#: Documents of a package; the kind of package goes by its number.
EACH = 20
KINDS = ["Contents/section0.xml", "word/document.xml", "ppt/presentation.xml", "xl/workbook.xml", None, None]


def _members(docs):
    """Every document as a member; packages of the fifth kind hold images."""
    number = F.floor(F.col("doc_id") / EACH)
    kind = number % 6
    name = F.concat(F.when(kind == 4, "img/").otherwise("text/"), F.col("doc_id").cast("string"), F.when(kind == 4, ".PNG").otherwise(".txt"))
    rows = docs.select(number.alias("package"), (F.col("doc_id") % EACH + 1).cast("int").alias("place"), name.alias("part"), F.encode(F.coalesce("text", F.lit("")), "utf-8").alias("content"))
    lead = docs.select(number.alias("package")).distinct().withColumn("part", F.get(F.array(*map(F.lit, KINDS)), (F.col("package") % 6).cast("int"))).where("part is not null")
    return rows.unionByName(lead.select("package", F.lit(0).alias("place"), "part", F.encode(F.lit("<x/>"), "utf-8").alias("content")))


def _written(spark, members):
    folder = shared_dir(spark, "packages")
    P.write_packages(members, folder).write.format("noop").mode("overwrite").save()
    return folder


def _number(path="path"):
    return F.regexp_extract(path, r"([0-9]+)\.zip$", 1).cast("long")


@query(
    "src14_package_parts",
    """SELECT doc_id // 20 AS package, 'text/' || doc_id || '.txt' AS part, octet_length(encode(coalesce(text, ''))) AS size, sha256(coalesce(text, '')) AS sha256 FROM documents WHERE (doc_id // 20) % 6 <> 4""",
)
def src14(spark, d):
    """Packages of documents, read back: the filter on the member's name reaches the source, which reads no other member."""
    parts = P.packages(spark, _written(spark, _members(table(spark, d, "documents"))))
    return parts.where(F.startswith("part", F.lit("text/"))).select(_number().alias("package"), "part", "size", F.sha2("content", 256).alias("sha256"))


@query(
    "src8_package_kinds",
    """WITH p AS (SELECT doc_id // 20 AS package, count(*) AS n FROM documents GROUP BY 1)
    SELECT package, CASE package % 6 WHEN 0 THEN 'hwpx' WHEN 1 THEN 'docx' WHEN 2 THEN 'pptx' WHEN 3 THEN 'xlsx' WHEN 4 THEN 'zip_images' ELSE 'zip_other' END AS kind,
    CASE WHEN package % 6 = 4 THEN n ELSE 0 END AS images FROM p""",
)
def src8_packages(spark, d):
    """Kinds that the members of a package decide; only directories are read."""
    parts = P.packages(spark, _written(spark, _members(table(spark, d, "documents"))), content=False)
    return P.package_kinds(parts).select(_number().alias("package"), "kind", "images")


def _book(docs):
    """Packages of the checked format: a paragraph a document, with a formula, and here and there a picture or a table."""
    n = F.col("doc_id")
    part = lambda when, text: F.when(when, text).otherwise("")
    formula = F.concat(F.lit('<hp:equation><hp:sz width="'), (F.col("n_chars") + 10000).cast("string"), F.lit('"/><hp:script>'), F.when(F.col("n_chars") >= 500, F.lit("x")).otherwise(" "), F.lit("</hp:script></hp:equation>"))
    text = F.concat(
        F.lit('<hp:p charPrIDRef="'), (n % 5).cast("string"), F.lit('">'), formula,
        part(n % 3 == 0, F.concat(F.lit('<hp:pic><hc:img binaryItemIDRef="image'), n.cast("string"), F.lit('"/></hp:pic>'))), part(n % 17 == 0, F.lit('<hp:tbl id="1"/>')), F.lit("</hp:p>"),
    )
    number = F.floor(n / EACH)
    one = docs.select(number.alias("package"), n.alias("doc_id"), text.alias("text")).groupBy("package").agg(X.ordered_concat(["doc_id"], "text", "").alias("body"), F.sort_array(F.collect_list("doc_id")).alias("ids"))
    space = ' xmlns:hp="p" xmlns:hc="c" xmlns:hh="h" xmlns:opf="o"'
    section = F.concat(F.lit(f"<hp:sec{space}>"), "body", F.lit("</hp:sec>"))
    header = F.concat(F.lit(f"<hh:head{space}>" + "".join(f'<hh:charPr id="{i}"/>' for i in range(4))), part(F.col("package") % 4 != 2, F.lit("</hh:head>")))
    items = F.array_join(F.transform(F.filter("ids", lambda i: i % 3 == 0), lambda i: F.concat(F.lit('<opf:item id="image'), i.cast("string"), F.lit('"/>'))), "")
    manifest = F.concat(F.lit(f"<opf:package{space}>"), items, F.lit("</opf:package>"))
    made = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(f"Contents/{name}").alias("part"), F.encode(x, "utf-8").alias("content")) for k, (name, x) in enumerate([("section0.xml", section), ("header.xml", header), ("content.hpf", manifest)])])
    media = F.transform(F.filter("ids", lambda i: i % 6 == 0), lambda i: F.struct(F.lit(9).alias("place"), F.concat(F.lit("BinData/image"), i.cast("string"), F.lit(".png")).alias("part"), F.encode(F.lit("png"), "utf-8").alias("content")))
    return one.select("package", F.explode(F.concat(made, media)).alias("x")).select("package", "x.*")


@query(
    "lint_package_checks",
    """WITH p AS (SELECT doc_id // 20 AS package, count(*) FILTER (doc_id % 3 = 0) AS pictures, count(*) FILTER (doc_id % 6 = 0) AS media, count(*) FILTER (doc_id % 5 = 4) AS undefined,
        count(*) FILTER (doc_id % 17 = 0) AS tables, count(*) FILTER (n_chars < 500) AS blank, max(n_chars + 10000) AS widest FROM documents GROUP BY 1)
    SELECT 'broken xml' AS check, package, 'header.xml' AS detail FROM p WHERE package % 4 = 2
    UNION ALL SELECT 'undefined charPrIDRef', package, '4' FROM p WHERE undefined > 0
    UNION ALL SELECT 'pictures differ from media', package, pictures || ' / ' || media FROM p WHERE pictures <> media
    UNION ALL SELECT 'no layout', package, 'neither two columns nor a table' FROM p WHERE tables = 0
    UNION ALL SELECT 'empty formula', package, CAST(blank AS VARCHAR) FROM p WHERE blank > 0
    UNION ALL SELECT 'formula wider than the column', package, CAST(widest AS VARCHAR) FROM p WHERE widest > 20268""",
)
def lint_packages(spark, d):
    """Violations in packages: broken parts, dangling references, pictures without media, layout and formulas."""
    parts = P.packages(spark, _written(spark, _book(table(spark, d, "documents"))))
    return package_checks.checks(parts).select("check", _number("key").alias("package"), "detail")


@query(
    "src11_reused_parse",
    """SELECT doc_id, len(l) AS n_lines, list_max(list_transform(l, lambda x: length(x))) AS longest, CASE WHEN doc_id % 10 = 3 THEN 1 ELSE 0 END AS run, (SELECT count(*) FROM documents WHERE doc_id % 10 = 3) AS parsed
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)""",
)
def src11(spark, d):
    """Documents parsed once, a tenth of them changed, and parsed again: the second run takes the changed ones alone."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    before = docs.withColumn("text", F.when(F.col("doc_id") % 10 == 3, F.concat("text", F.lit("\nold"))).otherwise(F.col("text")))
    with_digest = lambda df: df.withColumn("digest", F.sha2("text", 256))

    def parse(df):
        parts = F.split("text", "\n", -1)
        return df.select("doc_id", F.size(parts).cast("long").alias("n_lines"), F.array_max(F.transform(parts, lambda x: F.length(x))).cast("long").alias("longest"))

    store = shared_dir(spark, "parsed")
    reuse.reused(with_digest(before), "doc_id", ["digest"], parse, store)
    rows, parsed = reuse.reused(with_digest(docs), "doc_id", ["digest"], parse, store)
    return rows.select("doc_id", "n_lines", "longest", F.col("run").cast("int").alias("run"), F.lit(parsed).cast("long").alias("parsed"))
