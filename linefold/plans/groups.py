"""Queries for aggregations, sorts and sets (AGG, SRT, SET)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.functions import text as X
from linefold.operators import ordered
from linefold.plans.joins import _SIM_SQL, _pairs
from linefold.plans.registry import query
from linefold.plans.rows import MARKED_SQL, marked
from linefold.sources.tables import LINES_SQL, lines, table


@query("agg1_count_share", "SELECT event_type, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 4) AS share FROM events GROUP BY 1")
def agg1(spark, d):
    n = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n")).scalar()
    return n.select("event_type", "n", F.round(F.col("n") * 100.0 / total, 4).alias("share"))


@query(
    "agg2_crosstab",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1""",
)
def agg2(spark, d):
    t = table(spark, d, "orders").groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count().na.fill(0)
    return t.toDF("o_orderpriority", "f", "o", "p")


@query(
    "agg3_min_median_max",
    """SELECT l_returnflag, min(l_quantity) AS low, quantile_disc(l_quantity, 0.5 ORDER BY l_quantity DESC) AS median, max(l_quantity) AS high, count(*) AS n FROM
    (SELECT l_returnflag, l_quantity FROM lineitem) GROUP BY 1""".replace("quantile_disc(l_quantity, 0.5 ORDER BY l_quantity DESC)", "percentile_disc(0.5) WITHIN GROUP (ORDER BY l_quantity DESC)"),
)
def agg3(spark, d):
    """Upper median: percentile_disc over the descending order."""
    return table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.min("l_quantity").alias("low"), X.upper_median("l_quantity").alias("median"), F.max("l_quantity").alias("high"), F.count("*").alias("n"))


@query(
    "agg4_histogram",
    """WITH r AS (SELECT min(l_quantity) AS lo, greatest(max(l_quantity) - min(l_quantity), 1) AS span FROM lineitem),
    h AS (SELECT CAST(least(floor((l_quantity - lo) / span * 24), 23) AS BIGINT) AS bin, count(*) AS n FROM lineitem, r GROUP BY 1)
    SELECT b.bin, coalesce(n, 0) AS n FROM range(24) AS b(bin) LEFT JOIN h ON b.bin = h.bin""",
)
def agg4(spark, d):
    """24 equal bins, the last closed, empty ones included."""
    t = table(spark, d, "lineitem").select("l_quantity")
    r = t.agg(F.struct(F.min("l_quantity").alias("lo"), F.greatest(F.max("l_quantity") - F.min("l_quantity"), F.lit(1.0)).alias("span"))).scalar()
    bin_ = F.least(F.floor((F.col("l_quantity") - r["lo"]) / r["span"] * 24), F.lit(23)).alias("bin")
    h = t.select(bin_).groupBy("bin").agg(F.count("*").alias("n"))
    return spark.range(24).withColumnRenamed("id", "bin").join(h, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


@query("agg5_top2", "SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) <= 2")
def agg5(spark, d):
    """The two most frequent per group; of equals the first seen."""
    n = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("f"))
    return n.withColumn("k", F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("n"), "f"))).where("k <= 2").select("user_id", "event_type", "n")


_GAP_SQL = "g AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1e6 AS gap FROM events)"


def gaps(spark, d):
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").withColumn("gap", ordered.gap_to_previous(at, ["user_id"], ["ts", "event_id"]) / 1e6)


@query(
    "agg6_learned_gap",
    f"WITH {_GAP_SQL} SELECT user_id, greatest(60.0, 4 * percentile_disc(0.5) WITHIN GROUP (ORDER BY gap DESC)) AS threshold FROM g WHERE gap BETWEEN 0 AND 86400 GROUP BY user_id",
)
def agg6(spark, d):
    return ordered.learned_gap(gaps(spark, d), ["user_id"], "gap", 0, 86400, 4, 60)


@query(
    "agg7_learned_bands",
    """WITH b AS (SELECT user_id, CAST(floor(value / 5) AS BIGINT) AS bucket, count(*) AS n FROM events GROUP BY 1, 2)
    SELECT user_id, list_transform(list_sort(list(bucket)), lambda x: (x + 0.5) * 5)::VARCHAR AS centres FROM (SELECT *, max(n) OVER (PARTITION BY user_id) AS m FROM b) WHERE n >= 8 OR n = m GROUP BY user_id""".replace(
        "list_transform(list_sort(list(bucket)), lambda x: (x + 0.5) * 5)::VARCHAR AS centres", "string_agg(CAST(bucket AS VARCHAR), ',' ORDER BY bucket) AS buckets"
    ),
)
def agg7(spark, d):
    """Buckets that hold enough rows, or most."""
    b = table(spark, d, "events").groupBy("user_id", F.floor(F.col("value") / 5).alias("bucket")).agg(F.count("*").alias("n"))
    b = b.withColumn("m", F.max("n").over(Window.partitionBy("user_id"))).where("n >= 8 or n = m")
    return b.groupBy("user_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list("bucket")), lambda x: x.cast("string")), ",").alias("buckets"))


@query("agg8_marked_median", f"WITH {MARKED_SQL} SELECT name, percentile_disc(0.5) WITHIN GROUP (ORDER BY length(text) DESC) AS width FROM marked WHERE name IS NOT NULL GROUP BY name")
def agg8(spark, d):
    m = marked(spark, d).where("name is not null").withColumn("n", F.length("text"))
    return m.groupBy("name").agg(X.upper_median("n").cast("long").alias("width"))


@query(
    "agg9_p90",
    """SELECT l_suppkey, list_sort(list(l_quantity))[CAST(floor(count(*) * 0.9) AS BIGINT) + 1] AS p90, round(max(l_extendedprice) * 1.02, 2) AS widest FROM lineitem GROUP BY 1""",
)
def agg9(spark, d):
    """The value at index int(n * 0.9) of the sorted values, by rank rather than by collecting a group."""
    t = table(spark, d, "lineitem").select("l_suppkey", "l_quantity", "l_extendedprice")
    # quantities have few distinct values: cumulative counts per value stand for the sorted list
    n = t.groupBy("l_suppkey", "l_quantity").agg(F.count("*").alias("n"), F.max("l_extendedprice").alias("w"))
    w = Window.partitionBy("l_suppkey")
    n = n.withColumn("upto", F.sum("n").over(w.orderBy("l_quantity"))).withColumn("all", F.sum("n").over(w))
    at = F.min(F.when(F.col("upto") > F.floor(F.col("all") * 0.9), F.col("l_quantity")))
    return n.groupBy("l_suppkey").agg(at.alias("p90"), F.round(F.max("w") * 1.02, 2).alias("widest"))


@query(
    "agg10_score",
    """SELECT lang, count(*) FILTER (quality = 1 AND toxic = 0) AS exact, count(*) FILTER (quality = 0) AS missed, round_even(CASE WHEN count(*) > 0 THEN count(*) FILTER (quality = 1 AND toxic = 0) / count(*) ELSE 0 END, 4) AS accuracy
    FROM documents JOIN labels USING (doc_id) GROUP BY lang""",
)
def agg10(spark, d):
    """Conditional counts and rates, rounded half to even."""
    t = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id")
    exact = F.count_if((F.col("quality") == 1) & (F.col("toxic") == 0))
    return t.groupBy("lang").agg(exact.alias("exact"), F.count_if(F.col("quality") == 0).alias("missed"), F.bround(exact / F.count("*"), 4).alias("accuracy"))


@query("agg11_confusion", "SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality = 1 AND toxic = 0) AS fn, count(*) FILTER (quality = 0 AND toxic = 1) AS fp, count(*) FILTER (quality = 0 AND toxic = 0) AS tn FROM labels")
def agg11(spark, d):
    cell = lambda a, b: F.count_if((F.col("quality") == a) & (F.col("toxic") == b))
    return table(spark, d, "labels").agg(cell(1, 1).alias("tp"), cell(1, 0).alias("fn"), cell(0, 1).alias("fp"), cell(0, 0).alias("tn"))


@query(
    "agg12_boilerplate",
    rf"""WITH {LINES_SQL}, m AS (SELECT DISTINCT doc_id, text FROM lines WHERE length(text) >= 4 AND regexp_matches(text, '[A-Za-z]'))
    SELECT regexp_replace(text, '[0-9]+', '#', 'g') AS masked, count(*) AS n FROM m GROUP BY 1 HAVING count(*) >= greatest(2, (SELECT CAST(floor(count(*) * 0.004) AS BIGINT) FROM documents))""",
)
def agg12(spark, d):
    """Document frequency of masked lines over a share of all documents."""
    m = lines(spark, d).where((F.length("text") >= 4) & F.col("text").rlike("[A-Za-z]")).select("doc_id", "text").distinct()
    n = m.groupBy(X.mask_digits("text").alias("masked")).agg(F.count("*").alias("n"))
    least = table(spark, d, "documents").agg(F.greatest(F.lit(2), F.floor(F.count("*") * 0.004))).scalar()
    return n.where(F.col("n") >= least)


@query("agg13_distinct_pages", "SELECT source, count(DISTINCT lang) AS langs, count(DISTINCT (lang, n_chars)) AS shapes FROM documents GROUP BY source")
def agg13(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.countDistinct("lang").alias("langs"), F.countDistinct("lang", "n_chars").alias("shapes"))


@query("agg14_duplicate_groups", "SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first FROM documents GROUP BY 1 HAVING count(*) > 1")
def agg14(spark, d):
    return table(spark, d, "documents").groupBy(F.sha2("text", 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first")).where("n > 1")


@query(
    "agg15_folder_kinds",
    """WITH k AS (SELECT source, lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1, 2)
    SELECT source, lang, n, chars, CAST(sum(n) OVER (PARTITION BY source) AS BIGINT) AS total FROM k QUALIFY row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) <= 3""",
)
def agg15(spark, d):
    k = table(spark, d, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    w = Window.partitionBy("source")
    k = k.withColumn("total", F.sum("n").over(w)).withColumn("k", F.row_number().over(w.orderBy(F.desc("n"), "lang")))
    return k.where("k <= 3").select("source", "lang", "n", "chars", "total")


@query("agg16_file_totals", "SELECT o_orderpriority, round(avg(nullif(o_totalprice, 0)), 2) AS mean, min(o_totalprice) AS low, max(o_totalprice) AS high, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1")
def agg16(spark, d):
    c = F.col("o_totalprice")
    return table(spark, d, "orders").groupBy("o_orderpriority").agg(
        F.round(F.avg(F.nullif(c, F.lit(0.0))), 2).alias("mean"), F.min(c).alias("low"), F.max(c).alias("high"), F.sum(F.round(c * 100).cast("long")).alias("cents")
    )


@query("agg17_field_presence", "SELECT k AS field, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS k FROM events) GROUP BY 1")
def agg17(spark, d):
    return table(spark, d, "events").select(F.explode(F.json_object_keys("props")).alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query("agg18_keyword_counts", "SELECT lang, CAST(sum((length(text) - length(replace(text, 'the', ''))) // 3) AS BIGINT) AS n_the, CAST(sum((length(text) - length(replace(text, '###', ''))) // 3) AS BIGINT) AS n_hash FROM documents GROUP BY lang")
def agg18(spark, d):
    return table(spark, d, "documents").groupBy("lang").agg(F.sum(X.occurrences("text", "the")).alias("n_the"), F.sum(X.occurrences("text", "###")).alias("n_hash"))


@query(
    "agg19_pattern_hits",
    f"WITH {MARKED_SQL} SELECT name, count(*) AS n, percentile_disc(0.5) WITHIN GROUP (ORDER BY idx DESC) AS mid, min(doc_id * 33554432 + idx) AS example FROM marked WHERE name IS NOT NULL GROUP BY name",
)
def agg19(spark, d):
    m = marked(spark, d).where("name is not null")
    return m.groupBy("name").agg(F.count("*").alias("n"), X.upper_median("idx").cast("long").alias("mid"), F.min(F.col("doc_id") * (1 << 25) + F.col("idx")).alias("example"))


@query(
    "agg20_name_lengths",
    f"""WITH {MARKED_SQL}, s AS (SELECT doc_id, name, lead(idx) OVER (PARTITION BY doc_id ORDER BY idx) - idx AS n FROM marked WHERE name IS NOT NULL)
    SELECT name, count(*) AS segments, percentile_disc(0.5) WITHIN GROUP (ORDER BY n DESC) AS median, max(n) AS longest FROM s WHERE n IS NOT NULL GROUP BY name""",
)
def agg20(spark, d):
    m = marked(spark, d).where("name is not null").withColumn("n", F.lead("idx").over(Window.partitionBy("doc_id").orderBy("idx")) - F.col("idx")).where("n is not null")
    return m.groupBy("name").agg(F.count("*").alias("segments"), X.upper_median("n").cast("long").alias("median"), F.max("n").alias("longest"))


@query("agg21_accuracy_by_class", "SELECT source, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) FILTER (quality = 0) AS errors FROM documents JOIN labels USING (doc_id) GROUP BY source")
def agg21(spark, d):
    t = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    return t.groupBy("source").agg(F.round(F.avg((F.col("quality") == 1).cast("int")), 6).alias("accuracy"), F.count_if(F.col("quality") == 0).alias("errors"))


@query("agg22_conversion_counts", "SELECT source, count(*) FILTER (contains(text, '$$$')) AS math, count(*) FILTER (NOT contains(text, '$$$')) AS plain, count(*) FILTER (n_chars < 200) AS short FROM documents GROUP BY source")
def agg22(spark, d):
    math = F.contains("text", F.lit("$$$"))
    return table(spark, d, "documents").groupBy("source").agg(F.count_if(math).alias("math"), F.count_if(~math).alias("plain"), F.count_if(F.col("n_chars") < 200).alias("short"))


@query("agg23_prefix_flags", "SELECT conv_id, turn, max(CASE WHEN contains(text, 'tion.') THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) = 1 AS seen FROM conversations")
def agg23(spark, d):
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, d, "conversations").select("conv_id", "turn", (F.max(F.contains("text", F.lit("tion.")).cast("int")).over(w) == 1).alias("seen"))


@query(
    "agg24_cause_counts",
    f"""WITH {_SIM_SQL}, best AS (SELECT item_id, max(inter / (n + m - inter)) AS j FROM p GROUP BY 1)
    SELECT CASE WHEN j IS NULL OR j < 0.18 THEN 'not in source' WHEN j < 0.35 THEN 'weak' WHEN j < 0.85 THEN 'partial' ELSE 'found' END AS cause, count(*) AS n FROM benchmark LEFT JOIN best USING (item_id) GROUP BY 1""",
)
def agg24(spark, d):
    best = _pairs(spark, d, lambda inter, a, b: inter / (a + b - inter) >= 0.18).groupBy("item_id").agg(F.max("jaccard").alias("j"))
    j = F.col("j")
    cause = F.when(j.isNull() | (j < 0.18), "not in source").when(j < 0.35, "weak").when(j < 0.85, "partial").otherwise("found")
    return table(spark, d, "benchmark").join(best, "item_id", "left").groupBy(cause.alias("cause")).agg(F.count("*").alias("n"))


@query("agg25_ordered_concat", "SELECT l_orderkey, string_agg(l_returnflag || l_linestatus, '-' ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) AS flags FROM lineitem GROUP BY 1")
def agg25(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(X.ordered_concat(["l_linenumber", "l_partkey", "l_returnflag", "l_linestatus"], F.concat("l_returnflag", "l_linestatus"), "-").alias("flags"))


@query("srt1_stable_order", "SELECT doc_id, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars, doc_id) AS BIGINT) AS place FROM documents")
def srt1(spark, d):
    """A source may hold a third of all rows: its places come from ranges, not from one task."""
    return ordered.numbered_wide(table(spark, d, "documents").select("doc_id", "source", "n_chars"), ["source"], ["n_chars", "doc_id"], "place").select("doc_id", "place")


@query("srt2_smallest_first", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars, doc_id LIMIT 50")
def srt2(spark, d):
    return table(spark, d, "documents").select("doc_id", "n_chars").orderBy("n_chars", "doc_id").limit(50)


@query("srt3_nulls_last", "SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY nullif(event_type, 'view') ASC NULLS LAST, event_id) AS BIGINT) AS place FROM events")
def srt3(spark, d):
    e = table(spark, d, "events")
    return ordered.numbered(e, ["user_id"], [F.nullif(F.col("event_type"), F.lit("view")).asc_nulls_last(), "event_id"], "place").select("event_id", "place")


@query(
    "srt4_worst_per_verdict",
    """SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_returnflag ORDER BY CASE WHEN l_returnflag = 'R' THEN l_discount ELSE l_tax END, l_orderkey, l_linenumber, l_partkey) <= 8""",
)
def srt4(spark, d):
    """The worst 8 of each verdict by that verdict's own measure; Spark keeps 8 rows a task before the shuffle."""
    key = F.when(F.col("l_returnflag") == "R", F.col("l_discount")).otherwise(F.col("l_tax"))
    w = Window.partitionBy("l_returnflag").orderBy("worst", "l_orderkey", "l_linenumber", "l_partkey")
    t = table(spark, d, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", key.alias("worst"))
    return t.withColumn("k", F.row_number().over(w)).where("k <= 8").drop("k", "worst")


@query("srt5_top_counts", "SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 20")
def srt5(spark, d):
    return table(spark, d, "lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "l_partkey").limit(20)


@query(
    "srt6_head_and_others",
    """WITH c AS (SELECT p_brand AS name, count(*) AS n FROM part GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, name) AS k FROM c)
    SELECT CASE WHEN k <= 5 THEN name ELSE 'others' END AS name, CAST(sum(n) AS BIGINT) AS n FROM r GROUP BY 1""",
)
def srt6(spark, d):
    """The first five and what remains."""
    c = table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(F.count("*").alias("n"))
    head = c.orderBy(F.desc("n"), "name").limit(5).withColumn("is_head", F.lit(True))
    return c.join(F.broadcast(head.select("name", "is_head")), "name", "left").groupBy(F.when(F.col("is_head"), F.col("name")).otherwise("others").alias("name")).agg(F.sum("n").alias("n"))


@query("srt7_first_examples", f"WITH {MARKED_SQL} SELECT name, doc_id, idx FROM marked WHERE name IS NOT NULL QUALIFY row_number() OVER (PARTITION BY name ORDER BY doc_id, idx) <= 3")
def srt7(spark, d):
    w = Window.partitionBy("name").orderBy("doc_id", "idx")
    return marked(spark, d).where("name is not null").withColumn("k", F.row_number().over(w)).where("k <= 3").select("name", "doc_id", "idx")


@query("srt8_lowest_three", "SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) <= 3")
def srt8(spark, d):
    w = Window.partitionBy("user_id").orderBy("value", "event_id")
    return table(spark, d, "events").withColumn("k", F.row_number().over(w)).where("k <= 3").select("user_id", "event_id", "value")


@query("set1_union_all", "SELECT doc_id AS id, text FROM documents UNION ALL SELECT item_id, text FROM benchmark")
def set1(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text").unionByName(table(spark, d, "benchmark").select(F.col("item_id").alias("id"), "text"))


@query("set2_exact_dedup", f"WITH {LINES_SQL} SELECT doc_id, idx, text FROM lines QUALIFY text = '' OR row_number() OVER (PARTITION BY text ORDER BY doc_id, idx) = 1")
def set2(spark, d):
    """Keep-first over all documents, empty lines kept.

    The first place of each text comes from an aggregation (map-side partial, so a line
    that a third of all rows hold is one row per task), not from a window over all its rows.
    """
    t = lines(spark, d)
    first = t.where("text != ''").groupBy("text").agg(F.min(F.struct("doc_id", "idx")).alias("at")).select("at.doc_id", "at.idx", "text")
    return first.unionByName(t.where("text = ''"))


@query("set3_difference", "SELECT l_partkey AS part FROM lineitem WHERE l_quantity > 45 EXCEPT SELECT l_partkey FROM lineitem WHERE l_discount > 0.09")
def set3(spark, d):
    t = table(spark, d, "lineitem")
    return t.where("l_quantity > 45").select(F.col("l_partkey").alias("part")).subtract(t.where("l_discount > 0.09D").select("l_partkey"))


@query("set4_intersect", "SELECT l_suppkey AS supp FROM lineitem WHERE l_quantity > 49 INTERSECT SELECT s_suppkey FROM supplier WHERE s_acctbal > 0")
def set4(spark, d):
    return table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("supp")).intersect(table(spark, d, "supplier").where("s_acctbal > 0").select("s_suppkey"))


@query("set5_scope_union", "SELECT DISTINCT doc_id FROM (SELECT doc_id FROM labels UNION ALL SELECT doc_id FROM documents WHERE lang = 'fr')")
def set5(spark, d):
    return table(spark, d, "labels").select("doc_id").union(table(spark, d, "documents").where("lang = 'fr'").select("doc_id")).distinct()


@query(
    "set6_partition_of_inputs",
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'false' WHEN d.doc_id IS NULL THEN 'missed' ELSE 'paired' END AS part
    FROM (SELECT doc_id FROM documents WHERE lang <> 'de') d FULL JOIN (SELECT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
)
def set6(spark, d):
    """Paired, missed and false rows are disjoint and add up to the inputs."""
    a = table(spark, d, "documents").where("lang != 'de'").select("doc_id", F.lit(1).alias("a"))
    b = table(spark, d, "labels").select("doc_id", F.lit(1).alias("b"))
    return a.join(b, "doc_id", "full").select("doc_id", F.when(F.col("b").isNull(), "false").when(F.col("a").isNull(), "missed").otherwise("paired").alias("part"))


@query("set7_distinct", "SELECT DISTINCT lang, source FROM documents")
def set7(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()
