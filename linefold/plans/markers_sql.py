"""SQL of the marked lines and of segment ends on plain text lines."""

from linefold.sources.tables import LINES_SQL

_MARK = r"""CASE WHEN regexp_matches(text, '^\s*(?:Licensed|Released|This work)\b') THEN 'license' WHEN regexp_matches(text, '^\s*([A-Z]{2,})!!') THEN 'shout'
    WHEN regexp_matches(text, '^\s*(\w+)\s\|') THEN 'list' WHEN regexp_matches(text, '^\s*([0-9]{1,4})\b') THEN 'number'
    WHEN regexp_matches(text, '^\s*([A-Z][a-z]+)\.\s*$') THEN 'title' END"""
MARKED_SQL = f"{LINES_SQL}, marked AS (SELECT doc_id, idx, text, {_MARK} AS name FROM lines)"

ENDED_SQL = rf"""WITH {MARKED_SQL},
s AS (SELECT *, last_value(CASE WHEN name IN ('title', 'number', 'license') THEN idx END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY idx ROWS UNBOUNDED PRECEDING) AS start FROM marked),
f AS (SELECT *, idx // 10 AS page, length(text) > 900 AS far, text = '' AS passive, regexp_matches(text, '^[a-z]') AS joined, regexp_matches(text, 'tion[.]\s*$') AS order_end,
    contains(text, ', the') AS rider, name IS NOT DISTINCT FROM 'list' AS sub, name IS NOT DISTINCT FROM 'shout' AS solution,
    first_value(name) OVER (PARTITION BY doc_id, start ORDER BY idx) AS kind, row_number() OVER (PARTITION BY doc_id, start ORDER BY idx) - 1 AS pos FROM s WHERE start IS NOT NULL),
g AS (SELECT *, pos > 0 AND page <> lag(page) OVER w AS turned, coalesce(max(CASE WHEN order_end AND (pos = 0 OR (NOT passive AND ((joined AND NOT far) OR NOT sub))) THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id, start ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS seen FROM f WINDOW w AS (PARTITION BY doc_id, start ORDER BY idx)),
h AS (SELECT *, sum(CASE WHEN turned THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, start ORDER BY idx ROWS UNBOUNDED PRECEDING) AS pages,
    NOT passive AND NOT (joined AND NOT far) AND NOT (seen AND rider) AND NOT sub AS plain FROM g),
r AS (SELECT doc_id, start, idx, CASE WHEN pos = 0 THEN NULL WHEN turned AND pages > 1 THEN '페이지초과' WHEN seen AND far THEN '간격' WHEN pos >= 12 THEN '길이초과'
    WHEN plain AND kind = 'title' AND solution THEN '풀이시작' WHEN plain AND seen THEN '본문종료' END AS reason FROM h)
SELECT doc_id, start, coalesce(min(idx) FILTER (reason IS NOT NULL), max(idx) + 1) AS "end", coalesce(arg_min(reason, idx) FILTER (reason IS NOT NULL), '다음문제') AS reason FROM r GROUP BY doc_id, start"""
