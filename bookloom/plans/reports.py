"""Queries that look back on a run: issues, outcomes, lists, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.functions import text as T
from bookloom.operators import audit, lists
from bookloom.plans.portfolio import decisions, portfolio_select
from bookloom.session import materialize
from bookloom.sources.tables import table

#: The corpora that are audited.
CORPORA = ["corpus_a", "corpus_b"]


def _works(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "catalog_works").where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classifiedAt", "author", "title", "target", "reviewFlags")).alias("r"))
    return rows.select("id", "r.author", "r.title", "r.target", "r.reviewFlags")


def _flags(text: Column) -> Column:
    """What speaks against a unit's text: the quality gate, wrong decoding, noise at its ends."""
    size, words = F.octet_length(text), T.word_count(text)
    heavy = F.when(F.regexp_count(text, F.lit(T.SIGNALS)) > F.greatest(F.lit(20.0), words / 500), "heavy_mojibake")
    front = F.when(F.substring(text, 1, 5000).rlike(T.FRONT_NOISE), "frontmatter_noise")
    end = F.when(F.right(text, F.lit(5000)).rlike(T.END_NOISE), "endmatter_marketing")
    return F.concat(T.quality_reasons(size, words), F.array_compact(F.array(heavy, front, end)))


def audit_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Issues of catalogue, plan and units: flags, gaps in coverage, works in the wrong corpus or without plan, sources or good text.

    Planned are the works decided on, staged those with units, eligible those of
    the catalogue that aim at the corpus.
    """
    works = materialize(_works(spark, folder), "works")
    d = decisions(spark, folder).select("corpus", "id").where(F.col("corpus").isin(CORPORA))
    units = table(spark, folder, "book_units").where("workId IS NOT NULL").groupBy(F.col("workId").alias("id"), "unitIndex").agg(F.max(F.struct("loadedAt", "corpus", "content")).alias("r"))
    units = materialize(units.select("id", "unitIndex", "r.corpus", _flags(F.coalesce("r.content", F.lit(""))).alias("flags")).where(F.col("corpus").isin(CORPORA)), "units")
    staged = units.select("corpus", "id").distinct()
    eligible = works.where(F.col("target").isin(CORPORA)).select(F.col("target").alias("corpus"), "id")
    named = table(spark, folder, "catalog_works").select(F.explode("sourceVariants.fileId").alias("id"))
    files = table(spark, folder, "inventory_files").where("id IS NOT NULL").select("id").distinct()
    corpora = spark.createDataFrame([(c,) for c in CORPORA], "corpus string")
    issues = [
        audit.catalog_issues(works, CORPORA),
        audit.coverage_issues(files, named, corpora, d),
        audit.plan_issues(eligible, d, staged, works.select("id", "target")),
        audit.issues_of(units.where(F.size("flags") > 0), "markdown_quality", F.concat_ws(":", "id", "unitIndex", F.array_join("flags", "+")), "warning"),
    ]
    return reduce(DataFrame.unionByName, issues)


def audit_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Issues by severity and code."""
    return audit_issues(spark, folder).groupBy("severity", "code").agg(F.count(F.lit(1)).alias("issues"))


def decision_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """What became of every catalogued work, by target and outcome."""
    works = materialize(_works(spark, folder), "works")
    picked = materialize(portfolio_select(spark, folder), "picked")
    portfolio = decisions(spark, folder).select("id", F.coalesce("canonicalWorkId", "id").alias("canonicalWorkId"), F.col("portfolioRole").alias("reason"))
    units = table(spark, folder, "book_units").select(F.col("workId").alias("id")).distinct()
    left = picked.where("place IS NULL").groupBy("id").agg(F.min("reason").alias("exclusionReason"))
    report = audit.decisions_report(works, portfolio, picked.where("place IS NOT NULL").select("id"), left, units)
    return report.groupBy(F.coalesce("target", F.lit("null")).alias("target"), "outcome").agg(F.count(F.lit(1)).alias("works"))


def book_lists(spark: SparkSession, folder: str) -> DataFrame:
    """The works of each corpus as a list for people, line by line."""
    rows = _works(spark, folder).where(F.col("target").isin(CORPORA)).select(F.col("target").alias("corpus"), "id", "author", "title", F.lit("").alias("reason"))
    return lists.book_list(rows)


def response_check(spark: SparkSession, folder: str) -> DataFrame:
    """Responses against the scanned files and catalogued works of the same id: repeated, unexpected, complete."""
    r = table(spark, folder, "classifier_responses").where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("author", "title").alias("different"))
    return r.select("id", (F.col("n") > 1).alias("repeated"), (F.col("different") > 1).alias("conflicting"))


def status(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and different ids of each table, and when it was last written to."""
    parts = [("inventory_files", "id", "scannedAt"), ("catalog_works", "id", "classifiedAt"), ("curated_works", "id", "decidedAt"), ("book_units", "workId", "loadedAt"), ("documents", "doc_id", "loadedAt"), ("classifier_responses", "id", "classified_at")]
    rows = [table(spark, folder, t).agg(F.lit(t).alias("stage"), F.count(F.lit(1)).alias("rows"), F.countDistinct(i).alias("ids"), F.date_format(F.max(at), "yyyy-MM-dd HH:mm:ss").alias("last")) for t, i, at in parts]
    return reduce(DataFrame.unionByName, rows)


def manifest_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Per corpus the works, units and bytes there are, and the work of most bytes."""
    u = table(spark, folder, "book_units").where("workId IS NOT NULL").groupBy("workId", "unitIndex").agg(F.max(F.struct("loadedAt", F.coalesce("corpus", F.lit("null")).alias("corpus"), F.octet_length(F.coalesce("content", F.lit(""))).alias("b"))).alias("r"))
    works = u.groupBy("r.corpus", "workId").agg(F.count(F.lit(1)).alias("n"), F.sum("r.b").alias("b"))
    best = F.min(F.struct((-F.col("b")).alias("b"), "workId"))["workId"]
    return works.groupBy("corpus").agg(F.count(F.lit(1)).alias("works"), F.sum("n").alias("units"), F.sum("b").alias("bytes"), best.alias("largest"))


QUERIES = {f.__name__: f for f in (audit_issues, audit_counts, decision_outcomes, book_lists, response_check, manifest_totals, status)}

_D = "d AS (SELECT id, corpus FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY runId DESC, decidedAt DESC, loadedAt DESC) AS k FROM curated_works) WHERE k = 1 AND corpus IN ('corpus_a', 'corpus_b'))"
_N = lambda p: f"len(regexp_extract_all(content, '{p}'))"
_ISSUES = f"""{_D}, w AS (SELECT id, target, reviewFlags FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY classifiedAt DESC NULLS LAST, author DESC NULLS LAST, title DESC NULLS LAST, target DESC NULLS LAST) AS k FROM catalog_works WHERE id IS NOT NULL) WHERE k = 1),
e AS (SELECT target AS corpus, id FROM w WHERE target IN ('corpus_a', 'corpus_b')), c AS (SELECT unnest(['corpus_a', 'corpus_b']) AS corpus),
u0 AS (SELECT workId AS id, unitIndex, corpus, coalesce(content, '') AS content FROM (SELECT *, row_number() OVER (PARTITION BY workId, unitIndex ORDER BY loadedAt DESC NULLS LAST, corpus DESC NULLS LAST, content DESC NULLS LAST) AS k FROM book_units WHERE workId IS NOT NULL) WHERE k = 1),
u AS (SELECT *, list_filter([CASE WHEN strlen(content) < 2000 THEN 'too_small' END, CASE WHEN words < 300 THEN 'too_few_words' END, CASE WHEN signals > greatest(20.0, words / 500.0) THEN 'heavy_mojibake' END,
    CASE WHEN regexp_matches(substr(content, 1, 5000), '{T.FRONT_NOISE}') THEN 'frontmatter_noise' END, CASE WHEN regexp_matches(right(content, 5000), '{T.END_NOISE.replace(chr(39), chr(39) * 2)}') THEN 'endmatter_marketing' END], lambda x: x IS NOT NULL) AS flags
    FROM (SELECT *, {_N('[^\\s\\x{0B}]+')} AS words, {_N(T.SIGNALS)} AS signals FROM u0) WHERE corpus IN ('corpus_a', 'corpus_b')),
s AS (SELECT DISTINCT corpus, id FROM u),
i AS (SELECT 'warning' AS severity, 'catalog_review_flag' AS code, target AS corpus, id AS subject FROM w WHERE target IN ('corpus_a', 'corpus_b') AND len(reviewFlags) > 0
UNION SELECT 'error', 'classification_incomplete', NULL, id FROM inventory_files WHERE id IS NOT NULL AND id NOT IN (SELECT v.fileId FROM (SELECT unnest(sourceVariants) AS v FROM catalog_works) WHERE v.fileId IS NOT NULL)
UNION SELECT 'error', 'curation_incomplete', corpus, corpus FROM c WHERE corpus NOT IN (SELECT corpus FROM d)
UNION SELECT 'error', 'stale_conversion_plan_entry', d.corpus, d.id FROM d WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.id = d.id AND e.corpus = d.corpus)
UNION SELECT 'error', 'unstaged_work', d.corpus, d.id FROM d JOIN e ON e.id = d.id AND e.corpus = d.corpus WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.id = d.id AND s.corpus = d.corpus)
UNION SELECT 'error', 'unplanned_staged_work', s.corpus, s.id FROM s WHERE NOT EXISTS (SELECT 1 FROM d WHERE s.id = d.id AND s.corpus = d.corpus)
UNION SELECT 'error', 'wrong_target_folder', s.corpus, s.id FROM s LEFT JOIN w ON w.id = s.id WHERE w.target IS DISTINCT FROM s.corpus
UNION SELECT 'warning', 'markdown_quality', corpus, id || ':' || unitIndex || ':' || array_to_string(flags, '+') FROM u WHERE len(flags) > 0)"""
SQL = {
    "audit_issues": f"WITH {_ISSUES} SELECT severity, code, corpus, subject FROM i",
    "audit_counts": f"WITH {_ISSUES} SELECT severity, code, count(*) AS issues FROM i GROUP BY 1, 2",
    "response_check": "SELECT id, count(*) > 1 AS repeated, count(DISTINCT CASE WHEN author IS NOT NULL AND title IS NOT NULL THEN author || chr(0) || title END) > 1 AS conflicting FROM classifier_responses WHERE id IS NOT NULL GROUP BY id",
    "manifest_totals": """WITH u AS (SELECT workId, coalesce(corpus, 'null') AS corpus, strlen(coalesce(content, '')) AS b, row_number() OVER (PARTITION BY workId, unitIndex ORDER BY loadedAt DESC NULLS LAST, coalesce(corpus, 'null') DESC, strlen(coalesce(content, '')) DESC) AS k FROM book_units WHERE workId IS NOT NULL),
w AS (SELECT corpus, workId, count(*) AS n, sum(b) AS b FROM u WHERE k = 1 GROUP BY 1, 2) SELECT corpus, count(*) AS works, sum(n) AS units, sum(b) AS bytes, arg_min(workId, row(-b, workId)) AS largest FROM w GROUP BY corpus""",
    "status": " UNION ALL ".join(f"SELECT '{t}' AS stage, count(*) AS \"rows\", count(DISTINCT {i}) AS ids, strftime(max({at}), '%Y-%m-%d %H:%M:%S') AS \"last\" FROM {t}" for t, i, at in (("inventory_files", "id", "scannedAt"), ("catalog_works", "id", "classifiedAt"), ("curated_works", "id", "decidedAt"), ("book_units", "workId", "loadedAt"), ("documents", "doc_id", "loadedAt"), ("classifier_responses", "id", "classified_at"))),
}
