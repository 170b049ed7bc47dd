"""Queries over converted books: what blocks are, and what is left of a book without front and end matter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.functions import blocks as B
from bookloom.functions.text import word_count
from bookloom.session import materialize
from bookloom.sources.tables import table


def block_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """For every document, taken as the body of a block, what it looks like."""
    return B.block_flags(table(spark, folder, "documents").select("doc_id", "text"), "text").drop("text")


def trimmed_books(spark: SparkSession, folder: str) -> DataFrame:
    """Of each work the sections that are left once front and end matter is gone, in their order, by number and by first and last."""
    d = table(spark, folder, "documents").where("workId IS NOT NULL AND text IS NOT NULL").select("workId", F.struct(F.coalesce("sectionIndex", F.lit(-1)).alias("i"), "doc_id").alias("place"), "doc_id", "text")
    flagged = materialize(B.block_flags(d, "text").drop("text"), "flags")
    left = B.without_end(B.without_front(flagged, "workId", "place"), "workId")
    ends = left.groupBy("workId").agg(F.count(F.lit(1)).alias("kept"), F.min_by("doc_id", "at").alias("firstDoc"), F.max_by("doc_id", "at").alias("lastDoc"))
    return flagged.groupBy("workId").agg(F.count(F.lit(1)).alias("sections")).join(ends, "workId", "left").select("workId", "sections", F.coalesce("kept", F.lit(0)).alias("kept"), "firstDoc", "lastDoc")


def heading_bodies(spark: SparkSession, folder: str) -> DataFrame:
    """Heading and body of every unit, parted at the first blank line, as lengths."""
    parts = B.heading_and_body(F.col("content"))
    return table(spark, folder, "book_units").select("workId", "unitIndex", F.length(parts["heading"]).alias("headingChars"), F.length(parts["body"]).alias("bodyChars")).distinct()


def bibliography_cuts(spark: SparkSession, folder: str) -> DataFrame:
    """Every document after a short bibliography at its end was cut, as a length."""
    return table(spark, folder, "documents").select("doc_id", F.length(B.without_bibliography(F.col("text"))).alias("characters"))


def finished_units(spark: SparkSession, folder: str) -> DataFrame:
    """Every unit made ready for use, as words and a hash."""
    text = B.finished(F.col("content"))
    return table(spark, folder, "book_units").select("workId", "unitIndex", "content").distinct().select("workId", "unitIndex", text.alias("text")).select("workId", "unitIndex", word_count(F.col("text")).alias("words"), F.sha2("text", 256).alias("hash"))


QUERIES = {f.__name__: f for f in (block_kinds, trimmed_books, heading_bodies, bibliography_cuts, finished_units)}


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def _any(patterns: list[str]) -> str:
    return f"regexp_matches(low, '{_q('|'.join(patterns))}')"


def _two(patterns: list[str]) -> str:
    return "(" + " + ".join(f"CAST(regexp_matches(low, '{_q(p)}') AS INT)" for p in patterns) + " >= 2)"


_TRIM = " || ".join(f"chr({ord(c)})" for c in B.BLANKS)
_EVEN = r"regexp_replace({0}, '\r\n?', chr(10), 'g')"
_FLAGS = rf"""
l AS (SELECT *, list_filter(list_transform(string_split({_EVEN.format("coalesce(text, '')")}, chr(10)), lambda x: trim(x, {_TRIM})), lambda x: x <> '') AS lines, lower(coalesce(text, '')) AS low, len(regexp_extract_all(coalesce(text, ''), '[^\s\x{{0B}}]+')) AS words FROM src),
m AS (SELECT *, len(lines) AS n, coalesce(lines[1], '') AS first, len(list_filter(lines, lambda x: x LIKE '>%')) AS quotes, len(list_filter(lines, lambda x: length(x) <= 40)) AS short, len(list_filter(lines, lambda x: length(x) <= 120)) AS middling, len(list_filter(lines, lambda x: length(x) >= 60)) AS long,
    len(list_filter(lines, lambda x: regexp_matches(x, '{_q(B.REFERENCE_LINE)}'))) AS refs, len(list_filter(lines, lambda x: regexp_matches(x, '{_q(B.CONTENTS_LINE)}'))) AS entries, len(list_filter(lines, lambda x: regexp_matches(x, '{_q(B.ATTRIBUTION_LINE)}'))) > 0 AS signed FROM l),
k AS (SELECT *, NOT regexp_matches(first, '{_q(B.NUMBER_ENDS)}') AND regexp_matches(first, '{_q(B.TEXT_BEGINS)}') AS contentStart, {_two(B.AUTHOR_NOTE)} AS authorNote,
    (n > 0 AND quotes >= 2 AND quotes > 0.4 * n AND words < 180) OR (n BETWEEN 2 AND 10 AND words < 220 AND signed AND middling > 0.7 * n) AS epigraph, n > 0 AND short > 0.45 * n AS listLike, {_two(B.PUBLISHER)} AS publisher, {_any(B.MARKETING)} AS marketing,
    n >= 6 AND refs > 0.45 * n AS references_, regexp_matches(low, '\bcontents\b') AND entries >= 3 AS contents, {_any(B.END)} AS endMatter, regexp_matches(regexp_replace(first, '^#{{1,6}}\s*', ''), '{_q(B.END_OPENS)}') AS endStart FROM m),
f AS (SELECT *, {_any(B.FRONT)} OR publisher OR contents OR marketing OR authorNote OR epigraph AS frontMatter FROM k),
flags AS (SELECT *, n > 0 AND words >= 80 AND NOT frontMatter AND NOT contents AND NOT listLike AND long >= greatest(2, floor(n * 0.3)) AS mainText FROM f)"""
SQL = {
    "block_kinds": f"WITH src AS (SELECT doc_id, text FROM documents), {_FLAGS} SELECT doc_id, contentStart, authorNote, epigraph, listLike, publisher, marketing, references_ AS \"references\", contents, mainText, frontMatter, endMatter, endStart FROM flags",
    "trimmed_books": f"""WITH src AS (SELECT workId, doc_id, text, coalesce(sectionIndex, -1) AS i FROM documents WHERE workId IS NOT NULL AND text IS NOT NULL), {_FLAGS},
p AS (SELECT *, row_number() OVER (PARTITION BY workId ORDER BY i, doc_id) - 1 AS at0 FROM flags),
c AS (SELECT workId, count(*) AS sections, min(CASE WHEN (contentStart OR mainText) AND at0 <= 30 THEN at0 END) AS s, min(CASE WHEN contentStart OR mainText OR NOT frontMatter THEN at0 END) AS o FROM p GROUP BY workId),
x AS (SELECT p.*, at0 - CASE WHEN s > 0 THEN s ELSE coalesce(o, sections) END AS pos FROM p JOIN c USING (workId)),
y AS (SELECT *, count(*) OVER (PARTITION BY workId) AS m, sum(CAST(endStart OR references_ OR (endMatter AND listLike) OR marketing AS INT)) OVER (PARTITION BY workId ORDER BY pos DESC) AS back FROM x WHERE pos >= 0),
z AS (SELECT *, m - pos < 4 OR back >= 0.55 * (m - pos) AS sustained FROM y),
w AS (SELECT *, min(CASE WHEN pos >= floor(m * 0.8) AND ((endStart AND (pos >= m - 35 OR sustained)) OR marketing OR (endMatter AND (listLike OR references_) AND sustained) OR (references_ AND sustained)) THEN pos END) OVER (PARTITION BY workId) AS cut FROM z),
e AS (SELECT workId, count(*) AS kept, arg_min(doc_id, pos) AS firstDoc, arg_max(doc_id, pos) AS lastDoc FROM w WHERE cut IS NULL OR pos < cut GROUP BY workId)
SELECT workId, sections, coalesce(kept, 0) AS kept, firstDoc, lastDoc FROM c LEFT JOIN e USING (workId)""",
    "heading_bodies": f"""SELECT DISTINCT workId, unitIndex, length(trim(CASE WHEN pos > 0 THEN substr(t, 1, pos - 1) ELSE t END, {_TRIM})) AS headingChars, CASE WHEN pos > 0 THEN length(trim(substr(t, pos + 2), {_TRIM})) WHEN pos = 0 THEN 0 END AS bodyChars
FROM (SELECT *, CAST(instr(t, chr(10) || chr(10)) AS BIGINT) AS pos FROM (SELECT workId, unitIndex, {_EVEN.format('content')} AS t FROM book_units))""",
    "bibliography_cuts": rf"""SELECT doc_id, CASE WHEN found AND len(regexp_extract_all(substr(text, length(before) + 1), '[^\s\x{{0B}}]+')) <= 250 THEN length(trim(before, {_TRIM})) ELSE length(text) END AS characters
FROM (SELECT doc_id, text, regexp_matches(text, '{B.BIBLIOGRAPHY}') AS found, regexp_extract(text, '(?s)^(.*){B.BIBLIOGRAPHY}', 1) AS before FROM documents)""",
}
