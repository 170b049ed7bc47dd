"""Queries over whole documents and book units."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookloom.functions import text as T
from bookloom.session import materialize
from bookloom.sources.tables import table


def usable_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The outcome of each document: selected, an exact duplicate of another, or below the quality gate; a null text is empty and like no other."""
    d = table(spark, folder, "documents").select("doc_id", "text", "lang")
    measured = d.select("doc_id", "lang", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes"), F.coalesce(F.regexp_count("text", F.lit(r"[^ \t\r\n]+")), F.lit(0)).alias("words"), F.coalesce(F.sha2("text", 256), F.concat(F.lit("null:"), "doc_id")).alias("hash"))
    rank = F.when(F.col("lang").isin("cs", "en"), 0).when(F.col("lang").isNull(), 1).otherwise(2)
    measured = materialize(measured, "measured")  # texts are read and hashed once
    # a maximum is combined before the shuffle, so many copies of one text are no burden
    best = measured.groupBy("hash").agg(F.min(F.struct(rank.alias("rank"), "doc_id")).alias("s"))
    kept = measured.join(best.select("hash", F.col("s.doc_id").alias("survivor")), "hash")
    reasons = T.quality_reasons(F.col("bytes"), F.col("words"))
    outcome = F.when(F.col("survivor") != F.col("doc_id"), F.concat(F.lit("exact_duplicate:"), "survivor")).when(F.size(reasons) > 0, F.concat(F.lit("quality:"), F.array_join(reasons, "+"))).otherwise("selected")
    return kept.select("doc_id", "bytes", "words", outcome.alias("outcome"))


def doc_quality_gate(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes, words, decoding signals and the reasons and warnings they give."""
    d = table(spark, folder, "documents").select("doc_id", F.octet_length("text").alias("bytes"), T.word_count(F.col("text")).alias("words"), F.regexp_count("text", F.lit(T.SIGNALS)).alias("signals"))
    return d.select("*", F.array_join(T.quality_reasons(F.col("bytes"), F.col("words")), "+").alias("reasons"), (F.col("signals") > F.greatest(F.lit(20.0), F.col("words") / 500)).alias("heavyMojibake"))


def exact_duplicate_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Texts that stand more than once: their hash, the smallest document and the number of copies."""
    d = table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("hash"))
    return d.groupBy("hash").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies")).where("copies > 1")


def text_sample(spark: SparkSession, folder: str) -> DataFrame:
    """The head and tail of long documents, short ones whole, as a hash and a length."""
    body = F.when(F.length("text") > 18000, F.concat(F.substring("text", 1, 14000), F.lit(T.SAMPLE_END), F.right("text", F.lit(4000)))).otherwise(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", F.length(body).alias("sampleChars"), F.sha2(body, 256).alias("sampleHash"))


def unit_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Size, words, page and section marks, decoding signals and addresses of each book unit."""
    c = F.col("content")
    count = lambda pattern: F.regexp_count(c, F.lit(pattern)).alias
    return table(spark, folder, "book_units").select(
        "workId", "unitIndex", F.octet_length(c).alias("bytes"), F.length(c).alias("characters"), count(r"\S+")("words"), count(r"(?m)^## Page \d+\r?$")("pageMarks"), count(r"(?m)^## Section \d+\r?$")("sectionMarks"),
        count(r"â|Â|\x{FFFD}")("signals"), count(r"https?://\S+")("urls"),
    ).distinct()


def line_corruption(spark: SparkSession, folder: str) -> DataFrame:
    """Per document the lines that are destroyed and their bytes."""
    lines = F.transform(F.split("text", r"\r?\n"), lambda x: F.struct(x.alias("line"), T.corrupted_line(x).alias("bad")))
    rows = table(spark, folder, "documents").select("doc_id", F.filter(lines, lambda s: s["bad"]).alias("bad")).where(F.size("bad") > 0)
    return rows.select("doc_id", F.size("bad").alias("removedLines"), F.aggregate("bad", F.lit(0).cast("bigint"), lambda a, s: a + F.octet_length(s["line"]) + 1).alias("removedBytes"))


def sample_preflight(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a document can be judged at all: not extracted, unreadable, too short, or ok."""
    t = F.col("text")
    lost, marks, words = (F.coalesce(F.regexp_count(t, F.lit(p)), F.lit(0)) for p in (r"\x{FFFD}", T.SAMPLE_MARKS, T.SAMPLE_WORDS))
    return table(spark, folder, "documents").select("doc_id", lost.alias("lost"), marks.alias("marks"), words.alias("words"), T.sample_status(lost, marks, words, t.isNull()).alias("status"))


def markdown_cleanup(spark: SparkSession, folder: str) -> DataFrame:
    """Book units after all cleaning steps."""
    return table(spark, folder, "book_units").select("workId", "unitIndex", T.cleaned(F.col("content")).alias("content")).distinct()


def markdown_normal(spark: SparkSession, folder: str) -> DataFrame:
    """Book units with line ends, signs and control characters put right, as a hash."""
    body = T.normal_markdown(F.col("content"))
    return table(spark, folder, "book_units").select("workId", "unitIndex", F.length(body).alias("characters"), F.sha2(body, 256).alias("hash")).distinct()


def section_assembly(spark: SparkSession, folder: str) -> DataFrame:
    """Per work its sections of at least ten words, numbered by their first place, as one text's hash."""
    d = table(spark, folder, "documents").where("workId IS NOT NULL AND text IS NOT NULL").select("workId", "sectionIndex", "doc_id", "text")
    rows = d.where(T.word_count(F.col("text")) >= 10).select("workId", F.struct("sectionIndex", "doc_id", F.concat(F.lit("## Section "), "sectionIndex", F.lit("\n\n"), "text").alias("body")).alias("s"))
    # a work's sections make one book, which is one row whatever is done
    works = rows.groupBy("workId").agg(F.sort_array(F.collect_list("s")).alias("s"))
    return works.select("workId", F.size("s").alias("sections"), F.sha2(F.array_join(F.transform("s", lambda x: x["body"]), "\n\n"), 256).alias("hash"))


def payload_hash(spark: SparkSession, folder: str) -> DataFrame:
    """The hash of the lines of each unit that carry text."""
    return table(spark, folder, "book_units").select("workId", "unitIndex", F.sha2(T.payload(F.col("content")), 256).alias("hash")).distinct()


def accounting_invariant(spark: SparkSession, folder: str) -> DataFrame:
    """Documents by outcome beside the documents there are."""
    rows = usable_documents(spark, folder).select(F.split("outcome", ":")[0].alias("outcome"))
    counts = rows.agg(F.count_if(F.col("outcome") == "selected").alias("selected"), F.count_if(F.col("outcome") == "exact_duplicate").alias("duplicates"), F.count_if(F.col("outcome") == "quality").alias("belowGate"))
    return counts.crossJoin(table(spark, folder, "documents").agg(F.count(F.lit(1)).alias("documents"))).withColumn("balanced", F.col("selected") + F.col("duplicates") + F.col("belowGate") == F.col("documents"))


QUERIES = {f.__name__: f for f in (usable_documents, doc_quality_gate, exact_duplicate_groups, text_sample, unit_metrics, line_corruption, sample_preflight, markdown_cleanup, markdown_normal, section_assembly, payload_hash, accounting_invariant)}

_USABLE = r"""
WITH m AS (SELECT doc_id, coalesce(strlen(text), 0) AS bytes, coalesce(len(regexp_extract_all(text, '[^ \t\r\n]+')), 0) AS words,
        first_value(doc_id) OVER (PARTITION BY coalesce(sha256(text), 'null:' || doc_id) ORDER BY CASE WHEN lang IN ('cs', 'en') THEN 0 WHEN lang IS NULL THEN 1 ELSE 2 END, doc_id) AS survivor FROM documents)
SELECT doc_id, bytes, words, CASE WHEN survivor <> doc_id THEN 'exact_duplicate:' || survivor
    WHEN bytes < 2000 AND words < 300 THEN 'quality:too_small+too_few_words' WHEN bytes < 2000 THEN 'quality:too_small' WHEN words < 300 THEN 'quality:too_few_words' ELSE 'selected' END AS outcome FROM m
"""


def _n(pattern: str, column: str = "text") -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


def _mended(column: str) -> str:
    out = f"regexp_replace({column}, '\\r\\n?', chr(10), 'g')"
    for wrong, right in T.MOJIBAKE:
        out = f"replace({out}, '{wrong}', '{right.replace(chr(39), chr(39) * 2)}')"
    return out


_BODY = rf"regexp_replace(regexp_replace(regexp_replace({_mended('content')}, '{T.CONTROLS}', '', 'g'), '^\n+', ''), '\s+$', '')"
SQL = {
    "usable_documents": _USABLE,
    "doc_quality_gate": rf"""
SELECT *, CASE WHEN bytes < 2000 AND words < 300 THEN 'too_small+too_few_words' WHEN bytes < 2000 THEN 'too_small' WHEN words < 300 THEN 'too_few_words' ELSE '' END AS reasons, signals > greatest(20.0, words / 500.0) AS heavyMojibake
FROM (SELECT doc_id, strlen(text) AS bytes, {_n('[^\\s\\x{0B}]+')} AS words, {_n(T.SIGNALS)} AS signals FROM documents)""",
    "exact_duplicate_groups": "SELECT sha256(text) AS hash, min(doc_id) AS first_doc, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1",
    "text_sample": "SELECT doc_id, length(body) AS sampleChars, sha256(body) AS sampleHash FROM (SELECT doc_id, CASE WHEN length(text) > 18000 THEN substr(text, 1, 14000) || chr(10) || chr(10) || '[END SAMPLE]' || chr(10) || chr(10) || right(text, 4000) ELSE text END AS body FROM documents)",
    "unit_metrics": rf"""SELECT DISTINCT workId, unitIndex, strlen(content) AS bytes, length(content) AS characters, {_n('[^\\s\\x{0B}]+', 'content')} AS words, {_n('(?m)^## Page \\d+\\r?$', 'content')} AS pageMarks,
    {_n('(?m)^## Section \\d+\\r?$', 'content')} AS sectionMarks, {_n('â|Â|\\x{FFFD}', 'content')} AS signals, {_n('https?://\\S+', 'content')} AS urls FROM book_units""",
    "line_corruption": rf"""
WITH l AS (SELECT doc_id, line, trim(line) AS body FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\r?\n')) AS line FROM documents)),
m AS (SELECT *, {_n(T.SIGNALS, 'body')} AS s, greatest(length(regexp_replace(body, '[\s\x{{0B}}]', '', 'g')), 1) AS v, {_n('\\p{L}', 'body')} AS letters, {_n('[\\p{L}\\p{N}]{2,}', 'body')} AS wordy FROM l)
SELECT doc_id, count(*) AS removedLines, sum(strlen(line) + 1) AS removedBytes FROM m
WHERE body <> '' AND NOT regexp_matches(body, '^#{{1,6}}\s') AND ((s >= 8 AND s / v >= 0.08) OR (s >= 4 AND s / v >= 0.14) OR (s >= 6 AND letters / v < 0.18 AND wordy < 5)) GROUP BY doc_id""",
    "sample_preflight": rf"SELECT doc_id, lost, marks, words, CASE WHEN text IS NULL THEN 'extraction_failed' WHEN lost > 20 OR marks > 60 THEN 'unreadable' WHEN words < 30 THEN 'too_short' ELSE 'ok' END AS status FROM (SELECT doc_id, text, coalesce({_n('\\x{FFFD}')}, 0) AS lost, coalesce({_n('Ã.|Â.|â€|ðŸ')}, 0) AS marks, coalesce({_n('[\\p{L}\\p{N}]+')}, 0) AS words FROM documents)",
    "markdown_normal": f"SELECT DISTINCT workId, unitIndex, length(b) AS characters, sha256(b) AS hash FROM (SELECT workId, unitIndex, CASE WHEN body = '' THEN '' ELSE body || chr(10) END AS b FROM (SELECT workId, unitIndex, {_BODY} AS body FROM book_units))",
    "section_assembly": rf"""SELECT workId, count(*) AS sections, sha256(string_agg('## Section ' || sectionIndex || chr(10) || chr(10) || text, chr(10) || chr(10) ORDER BY sectionIndex NULLS FIRST, doc_id)) AS hash
FROM documents WHERE workId IS NOT NULL AND {_n('[^\\s\\x{0B}]+')} >= 10 GROUP BY workId""",
    "payload_hash": rf"""SELECT DISTINCT workId, unitIndex, sha256(array_to_string(list_filter(regexp_split_to_array(content, '\r?\n'), lambda x: regexp_matches(x, '[^\s\x{{0B}}]') AND NOT regexp_matches(x, '{T.NO_PAYLOAD}')), chr(10))) AS hash FROM book_units""",
    "accounting_invariant": f"""WITH o AS ({_USABLE.strip().replace('WITH m AS', 'WITH m AS')}) SELECT count_if(outcome = 'selected') AS selected, count_if(outcome LIKE 'exact_duplicate%') AS duplicates, count_if(outcome LIKE 'quality%') AS belowGate,
    (SELECT count(*) FROM documents) AS documents, count(*) = (SELECT count(*) FROM documents) AS balanced FROM o""",
}
