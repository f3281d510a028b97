"""Queries with the rules of the reference parser: its ordered clean-up and its block labels (PRJ-11, WIN-24)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from linefold.operators import reference_text as R
from linefold.plans.registry import query
from linefold.sources.tables import LINES_SQL, lines

#: What is put behind lines, so that every step of the clean-up has something to take off.
TAILS = ["", " 1-2-3. 가나", " 가나다1-2-3.", " [기본 문제]", " 서술형", " [공학적 도구]", " 비상 수학 1", ". 합계 가", ". 가나 ※ 무엇", "시. 가나다", " 가나 내신대비 12", " 서술형 미래엔 미적분 Ⅱ", " 심화 문제 [수학 놀이] YBM 기하"]


def _sql_tail() -> str:
    """The same steps in SQL, whose patterns know no look-behind: what stands before is put back."""
    t = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
    plain = lambda p: p.replace("(?U)", "").replace("'", "''")
    for p, _ in R.TAIL_BEFORE + R.TAIL_LABELS + R.TAIL_AFTER:
        t = f"regexp_replace({t}, '{plain(p)}', '', 'g')"
    back = lambda t, p, before: f"regexp_replace({t}, '({before}){plain(p).replace('(?<=' + before + ')', '')}', '\\1', 'g')"
    steps = f"SELECT doc_id, idx, CASE WHEN contains(right(t, 60), '합계') THEN {back('t', R.TABLE_TAIL, '[.．]')} ELSE t END AS t FROM (SELECT doc_id, idx, {t} AS t FROM put)"
    t = back("t", R.TAIL_LAST[0][0], "[.．]")
    t = back(t, R.TAIL_LAST[1][0], "[시라자다까오][.．]")
    return f"SELECT doc_id, idx, trim(regexp_replace({t}, '{plain(R.TAIL_LAST[2][0])}', '', 'g')) AS text FROM ({steps})"


@query("prj11_clean_tails", f"WITH {LINES_SQL}, put AS (SELECT doc_id, idx, text || {TAILS!r}[(doc_id + idx) % {len(TAILS)} + 1] AS text FROM lines) {_sql_tail()}")
def prj11_tails(spark, d):
    """The ten steps that take sections, labels, publishers, table feet and notes off the end of a problem, in order."""
    tail = F.get(F.array(*map(F.lit, TAILS)), ((F.col("doc_id") + F.col("idx")) % len(TAILS)).cast("int"))
    text = R.clean_tail(F.concat("text", tail))
    return lines(spark, d).select("doc_id", "idx", F.trim(text).alias("text"))


_LABELLED = f"text || CASE WHEN idx % 9 = 4 THEN ' ' || {R.BLOCK_LABELS!r}[(doc_id + idx) % {len(R.BLOCK_LABELS)} + 1] ELSE '' END"


@query(
    "win24_last_listed_label",
    f"""WITH {LINES_SQL}, put AS (SELECT doc_id, idx, {_LABELLED} AS text FROM lines),
    t AS (SELECT doc_id, idx, right(string_agg(right(text, 120), ' ') OVER (PARTITION BY doc_id ORDER BY idx ROWS BETWEEN 121 PRECEDING AND 1 PRECEDING) || ' ', 120) AS tail FROM put)
    SELECT doc_id, idx, CASE {" ".join(f"WHEN contains(tail, '{x}') THEN '{x}'" for x in reversed(R.BLOCK_LABELS))} END AS block FROM t WHERE idx % 3 = 1""",
)
def win24_label(spark, d):
    """The block label within the 120 characters before an item, across lines; of several the last listed."""
    label = F.get(F.array(*map(F.lit, R.BLOCK_LABELS)), ((F.col("doc_id") + F.col("idx")) % len(R.BLOCK_LABELS)).cast("int"))
    put = lines(spark, d).withColumn("text", F.concat("text", F.when(F.col("idx") % 9 == 4, F.concat(F.lit(" "), label)).otherwise("")))
    before = F.collect_list(F.right("text", F.lit(120))).over(Window.partitionBy("doc_id").orderBy("idx").rowsBetween(-121, -1))
    tail = F.right(F.concat(F.array_join(before, " "), F.lit(" ")), F.lit(120))
    return put.withColumn("tail", tail).where("idx % 3 = 1").select("doc_id", "idx", R.label_in(F.col("tail")).alias("block"))
