"""DuckDB SQL of those queries that SQL can express over whole tables."""

from __future__ import annotations

from bookloom.llm.split import LIMIT_BYTES
from bookloom.llm.survivor import PLACEHOLDERS

_BLANKS = r"'^\s+|\s+$'"
_MISSING = ", ".join(f"'{p}'" for p in PLACEHOLDERS)


def _filled(column: str) -> str:
    text = rf"lower(regexp_replace(regexp_replace({column}, {_BLANKS}, '', 'g'), '\s+', ' ', 'g'))"
    return f"({column} IS NOT NULL AND {text} <> '' AND {text} NOT IN ({_MISSING}))"


P3_FOUND = f"""
WITH RECURSIVE ties AS (
    SELECT a.id AS x, b.id AS y FROM catalog_works a JOIN catalog_works b ON a.canonicalWorkId = b.id
    UNION SELECT a.id, b.id FROM catalog_works a JOIN catalog_works b ON lower(trim(a.editionGroupKey)) = lower(trim(b.editionGroupKey)) WHERE {_filled('a.editionGroupKey')}
    UNION SELECT a.id, b.id FROM (SELECT id, unnest(sourceVariants) AS v FROM catalog_works) a JOIN (SELECT id, unnest(sourceVariants) AS v FROM catalog_works) b ON a.v.sha256 = b.v.sha256 WHERE a.v.size > 0 AND b.v.size > 0
), both_ways AS (SELECT x, y FROM ties UNION SELECT y, x FROM ties),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
grouped AS (SELECT x AS id, min(y) AS group_id, count(*) AS n FROM (SELECT x, y FROM reach UNION SELECT x, x FROM reach) GROUP BY x HAVING count(*) > 1),
marks AS (
    SELECT g.group_id, c.id, {' + '.join(f"CAST({_filled('c.' + f)} AS INT)" for f in ('author', 'title', 'language', 'summaryCz', 'editionNote', 'reasonCz'))}
        + CAST(coalesce(len(c.sourceVariants), 0) > 0 AS INT) AS f, c.classifiedAt AS t, CASE lower(trim(c.confidence)) WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END AS k
    FROM grouped g JOIN catalog_works c ON c.id = g.id
), top AS (SELECT *, max(f) OVER w AS mf, max(t) OVER w AS mt, max(k) OVER w AS mk FROM marks WINDOW w AS (PARTITION BY group_id))
SELECT group_id, min(id) AS survivor_id FROM top WHERE f = mf AND t = mt AND k = mk GROUP BY group_id HAVING count(*) = 1
"""

P4_FOUND = r"""
WITH counted AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY runId, id ORDER BY decidedAt DESC, loadedAt DESC) AS k FROM curated_works) WHERE k = 1
), keyed AS (SELECT *, lower(regexp_replace(regexp_replace(creatorKey, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g')) AS creator FROM counted),
ranked AS (
    SELECT runId, id, max(authorSoftMaximum) OVER (PARTITION BY runId, corpus, creator) AS cap,
        row_number() OVER (PARTITION BY runId, corpus, creator ORDER BY priorityScore DESC NULLS LAST, id) AS place
    FROM keyed WHERE creator <> ''
)
SELECT runId, id FROM ranked WHERE place > cap
"""

P5_FOUND = rf"""
WITH u AS (SELECT workId, unitIndex, arg_max(content, loadedAt) AS content FROM book_units GROUP BY workId, unitIndex),
big AS (SELECT * FROM u WHERE strlen(content) > {LIMIT_BYTES}),
blocks AS (SELECT workId, unitIndex, max(strlen(regexp_replace(p, '[\r\n]+$', ''))) AS most FROM (SELECT workId, unitIndex, unnest(regexp_split_to_array(content, '\n(?:[ \t\r]*\n)+')) AS p FROM big) GROUP BY workId, unitIndex)
SELECT workId, unitIndex, 'unit' AS kind FROM big
UNION ALL SELECT workId, unitIndex, 'block' FROM blocks WHERE most > {LIMIT_BYTES}
"""

P9_FOUND = """
WITH runs AS (SELECT doc_id, substr(text, CAST(i AS BIGINT), 200) AS run FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200)),
shared AS (SELECT hash(run) AS h, doc_id FROM runs GROUP BY ALL)
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM shared a JOIN shared b ON a.h = b.h AND a.doc_id < b.doc_id
"""


P9_SHARED_PART = """
WITH RECURSIVE runs AS (SELECT doc_id, i, hash(substr(text, CAST(i AS BIGINT), 200)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 198)) AS i FROM documents WHERE length(text) >= 200)),
several AS (SELECT h FROM runs GROUP BY h HAVING count(DISTINCT doc_id) > 1), own AS (SELECT doc_id, h, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM runs JOIN several USING (h)),
covered AS (SELECT doc_id, sum(least(200, coalesce(nx - i, 200))) AS chars, count_if(nx IS NULL OR nx > i + 200) AS passages FROM own GROUP BY doc_id),
keyed AS (SELECT DISTINCT doc_id, h FROM own), stars AS (SELECT DISTINCT doc_id AS x, min(doc_id) OVER (PARTITION BY h) AS y FROM keyed), ties AS (SELECT x, y FROM stars UNION SELECT y, x FROM stars),
reach AS (SELECT x, y FROM ties UNION SELECT r.x, t.y FROM reach r JOIN ties t ON r.y = t.x), tied AS (SELECT x AS doc_id, min(y) AS component FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(length(text), 0) AS n_chars, coalesce(passages, 0) AS passages, coalesce(chars, 0) AS shared_chars, CASE WHEN length(text) > 0 THEN coalesce(chars, 0) / length(text) ELSE 0 END AS share, component, component IS NULL OR component = d.doc_id AS keep
FROM documents d LEFT JOIN covered USING (doc_id) LEFT JOIN tied USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    return {"p3_found": P3_FOUND, "p4_found": P4_FOUND, "p5_found": P5_FOUND, "p9_found": P9_FOUND, "p9_shared_part": P9_SHARED_PART}
