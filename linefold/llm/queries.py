"""One query per operator, over the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linefold.llm import (
    bpe,
    chat_format,
    decontaminate,
    hard_negatives,
    language_id,
    license_scan,
    media_columns,
    near_dedup,
    quality_knn,
    quality_rules,
    secret_scan,
    source_divergence,
    toxicity,
)
from linefold.llm.common import held_out, read, written

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.collapse(read(spark, sf_dir, "conversations"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    grammar = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    found = toxicity.detect(docs, grammar, keep=["doc_id"])
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), F.size("clauses").cast("long").alias("n_clauses")
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, secret_scan.fit(docs), keep=["doc_id"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("findings", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("findings", lambda x: x["base"])
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


def op4_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = quality_knn.rate(docs, quality_knn.fit(docs, read(spark, sf_dir, "labels")), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.matches(read(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = decontaminate.blocks_of(read(spark, sf_dir, "benchmark"))
    found = decontaminate.scan(read(spark, sf_dir, "documents"), blocks, keep=["doc_id"])
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated"
    )


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read(spark, sf_dir, "documents"), VOCABULARY, PATTERN, keep=["doc_id"])


def op10_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = media_columns.store(read(spark, sf_dir, "documents"))
    heads = media_columns.header_columns(media_columns.located(rows))  # reads no more than the headers
    new = ["payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "width", "height"]
    # as a table, so that the join with the rows may split the copies of one text
    found = written(media_columns.read_back(heads).select("digest", *new), "media-columns")
    out = rows.select("doc_id", "n_bytes", "payload_bytes", "digest").join(found, "digest")
    shown = [F.lower(F.hex(c)).alias(c) if c.endswith("sha256") else c for c in new]
    return out.select("doc_id", "n_bytes", "payload_bytes", *shown)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(read(spark, sf_dir, "documents"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that every row shows are columns; the further rules measure only what the base rules leave."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    shown = ["word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    have = quality_rules.Measures("text", ("n_words", *shown))
    known = quality_rules.profile(docs, quality_rules.FURTHER, quality_rules.Measures("text"))
    order = quality_rules.ordered(quality_rules.FURTHER, known)
    rows = quality_rules.measured(docs, ["n_words", *shown])
    failed = [r.fails(have) for r in quality_rules.BASE]
    rows = rows.withColumn("base_failed", failed[0] | failed[1])
    base = quality_rules.Rule("base", lambda m: F.col("base_failed"))
    return quality_rules.cascade(rows, [base, *order], have).select("doc_id", "n_words", *shown, "base_failed", "kept")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(read(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 50 == 0)


QUERIES = {
    f.__name__: f
    for f in (
        op1_chat_format,
        op2_toxicity,
        op3_secret_scan,
        op4_quality_knn,
        op5_license_scan,
        op6_decontaminate,
        op7_minhash_near_dedup,
        op8_language_id,
        op9_byte_bpe,
        op10_media_columns,
        op11_source_divergence,
        op12_quality_rules,
        op13_hard_negatives,
    )
}

#: ASCII letters in lower case, in SQL.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The other operators run Python over texts or fit models; their tests compare with brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_chat_format": """
        WITH t AS (
            SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS n
            FROM conversations WHERE conv_id IS NOT NULL),
        p AS (
            SELECT conv_id, n, n = max(n) OVER (PARTITION BY conv_id) AS is_last,
                   string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '')
                       OVER (PARTITION BY conv_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS chat
            FROM t),
        whole AS (SELECT min(conv_id) AS conv_id, n AS n_turns, count(*) AS n_same, chat FROM p WHERE is_last GROUP BY n, chat)
        SELECT conv_id, n_turns, n_same, chat FROM whole
        WHERE chat NOT IN (SELECT chat FROM p WHERE NOT is_last)""",
    "op6_decontaminate": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
            FROM (SELECT item_id, w, least(13, len(w)) AS n FROM b WHERE len(w) > 0), unnest(range(1, len(w) - n + 2)) AS t(i)),
        dw AS (
            SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS g
            FROM d, (SELECT DISTINCT n FROM bw), unnest(range(1, len(w) - n + 2)) AS u(p)),
        hits AS (SELECT doc_id, p, n, item_id FROM dw JOIN bw USING (n, g)),
        spots AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
        own AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN own USING (doc_id)""",
    "op7_minhash_near_dedup": rf"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
            FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
            JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 85 * (x.n + y.n - count(*))),
        reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM c LEFT JOIN n USING (doc_id)""",
    "op11_source_divergence": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
        g AS (SELECT DISTINCT lang, source FROM d),
        t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
        k AS (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN k USING (lang, term) GROUP BY ALL),
        v AS (SELECT lang, count(*) AS v FROM k GROUP BY ALL),
        whole AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
        p AS (
            SELECT *, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p,
                   1 + (1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
            FROM whole JOIN v USING (lang)),
        two AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
        pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN two ON two.lang = a.lang AND two.source = a.source AND two.item = b.source),
        terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q)
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10""",
    "op12_quality_rules": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
        win AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM w, unnest(range(1, len(w) - 6)) AS u(i)),
        twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
        again AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS q FROM twice) GROUP BY r),
        m AS (
            SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                   len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, len(l) AS n_lines, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_shouts,
                   length(t) - length(regexp_replace(t, '\p{L}', '', 'g')) AS n_letters, length(t) - length(regexp_replace(t, '\p{Lu}', '', 'g')) AS n_capitals,
                   length(regexp_replace(t, '[^0-9]', '', 'g')) AS n_digits, len(list_filter(w, lambda x: length(x) >= 200)) AS n_long_runs
            FROM w LEFT JOIN again USING (r)),
        b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               NOT (base_failed OR 100 * n_symbols > 30 * n_words OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_shouts > 50 * n_words OR 100 * n_capitals > 70 * n_letters
                    OR 100 * n_digits > 50 * word_chars OR 100 * n_letters < 30 * word_chars OR 10 * n_long_runs > n_words) AS kept
        FROM b""",
    "op13_hard_negatives": """
        WITH e AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
            FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
        s AS (
            SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
            FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT a, b, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
        n AS (
            SELECT p.a AS anchor_id, p.b AS positive_id, s.b AS negative_id, p.score AS positive_score, s.score AS negative_score
            FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
        SELECT *, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank FROM n QUALIFY rank <= 3""",
}
