"""An audit of a finished run: each rule is a table of issues (severity, code, corpus, subject)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a corpus may have: files of books, files in all, files kept for others, bytes and tokens of a file.
LIMITS = {"files": 18, "knowledgeFiles": 20, "reserved": 2, "bytes": 12_000_000, "tokens": 2_000_000}


def issues_of(rows: DataFrame, code: str, subject: str | Column, severity: str = "error") -> DataFrame:
    """One issue for each different subject."""
    what = F.col(subject) if isinstance(subject, str) else subject
    return rows.select(F.lit(severity).alias("severity"), F.lit(code).alias("code"), F.col("corpus").cast("string").alias("corpus"), what.cast("string").alias("subject")).distinct()


def _without(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right.select(*on).distinct(), on, "left_anti")


def catalog_issues(works: DataFrame, corpora: list[str]) -> DataFrame:
    """Works (id, target, reviewFlags) of the audited corpora that carry review flags."""
    rows = works.where(F.col("target").isin(corpora) & (F.size("reviewFlags") > 0)).withColumn("corpus", F.col("target"))
    return issues_of(rows, "catalog_review_flag", "id", "warning")


def coverage_issues(candidates: DataFrame, classified: DataFrame, corpora: DataFrame, curated: DataFrame, partial: bool = False) -> DataFrame:
    """Candidates (id) nobody classified (id), warnings only in a partial run, and corpora (corpus) nobody curated (corpus)."""
    left = _without(candidates, classified, ["id"]).withColumn("corpus", F.lit(None).cast("string"))
    return issues_of(left, "classification_incomplete", "id", "warning" if partial else "error").unionByName(issues_of(_without(corpora, curated, ["corpus"]), "curation_incomplete", "corpus"))


def plan_issues(eligible: DataFrame, planned: DataFrame, staged: DataFrame, targets: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Eligible, planned and staged works (corpus, id) against one another and against their targets (id, target).

    ``totals`` (corpus, total) is how many works the plan says were eligible.
    """
    on = ["corpus", "id"]
    out = [
        issues_of(_without(planned, eligible, on), "stale_conversion_plan_entry", "id"),
        issues_of(_without(planned.join(eligible.select(on).distinct(), on, "left_semi"), staged, on), "unstaged_work", "id"),
        issues_of(_without(staged, planned, on), "unplanned_staged_work", "id"),
        issues_of(staged.join(targets, "id", "left").where(~F.col("target").eqNullSafe(F.col("corpus"))), "wrong_target_folder", "id"),
    ]
    if totals is not None:
        counted = eligible.distinct().groupBy("corpus").agg(F.count(F.lit(1)).alias("n"))
        out.append(issues_of(totals.join(counted, "corpus", "left").where(F.col("total") != F.coalesce("n", F.lit(0))), "stale_conversion_plan_count", "corpus"))
    return reduce(DataFrame.unionByName, out)


def conversion_issues(staged: DataFrame, sources: DataFrame, staged_files: DataFrame, markdown: DataFrame) -> DataFrame:
    """Staged works (corpus, id, source, name, markdown) against sources (path), staged files (corpus, name) and Markdown (corpus, name, flags)."""
    want = staged.select("corpus", F.col("markdown").alias("name"), "id")
    flagged = markdown.join(want, ["corpus", "name"]).where(F.size("flags") > 0)
    return reduce(DataFrame.unionByName, [
        issues_of(staged.join(sources.select(F.col("path").alias("source")).distinct(), "source", "left_anti"), "missing_source", "id"),
        issues_of(_without(staged, staged_files, ["corpus", "name"]), "missing_staged_file", "id"),
        issues_of(_without(want, markdown, ["corpus", "name"]), "conversion_failed", "id", "warning"),
        issues_of(flagged, "markdown_quality", F.concat_ws(":", "id", F.array_join("flags", "+")), "warning"),
        issues_of(_without(markdown, want, ["corpus", "name"]), "orphaned_markdown", "name"),
    ])


def selection_issues(selected: DataFrame, excluded: DataFrame, eligible: DataFrame, staged: DataFrame, content: DataFrame) -> DataFrame:
    """Selected and excluded works (corpus, id) against the eligible and staged ones, and against one another by content (id, content).

    Two selected works that hold some of the same content overlap; both ids are
    named, the smaller first.
    """
    on = ["corpus", "id"]
    held = selected.select(on).distinct().join(content.distinct(), "id")
    x, y = (held.select("corpus", "content", F.col("id").alias(s)) for s in "xy")
    pairs = x.join(y, ["corpus", "content"]).where("x < y")
    counted = lambda d, name: d.select(on).distinct().groupBy("corpus").agg(F.count(F.lit(1)).alias(name))
    sums = counted(eligible, "e").join(counted(selected.select(on).unionByName(excluded.select(on)), "s"), "corpus", "left")
    return reduce(DataFrame.unionByName, [
        issues_of(_without(selected, staged, on), "selected_unconverted_work", "id"),
        issues_of(pairs, "selected_containment_overlap", F.concat_ws("|", "x", "y")),
        issues_of(sums.where(F.col("e") != F.coalesce("s", F.lit(0))), "incomplete_merge_accounting", "corpus"),
    ])


def file_issues(corpora: DataFrame, reported: DataFrame, found: DataFrame, limits: dict[str, int] = LIMITS) -> DataFrame:
    """Merged files that the report names (corpus, name) and those found (corpus, name, bytes, tokens), by presence and limits."""
    on = ["corpus", "name"]
    named = reported.select(on).distinct()
    there = found.join(named, on, "left_semi")
    counts = named.groupBy("corpus").agg(F.count(F.lit(1)).alias("n"))
    return reduce(DataFrame.unionByName, [
        issues_of(_without(corpora, reported, ["corpus"]), "missing_merge_report", "corpus"),
        issues_of(_without(named, found, on), "missing_merged_file", "name"),
        issues_of(_without(found, named, on), "orphaned_merged_file", "name"),
        issues_of(counts.where(F.col("n") > limits["files"]), "too_many_upload_files", "n"),
        issues_of(counts.where(F.col("n") + limits["reserved"] > limits["knowledgeFiles"]), "too_many_total_knowledge_files", "n"),
        issues_of(there.where(F.col("bytes") > limits["bytes"]), "upload_file_too_large", "name"),
        issues_of(there.where(F.col("tokens") > limits["tokens"]), "upload_file_too_many_tokens", "name"),
    ])


def report_issues(validation: DataFrame) -> DataFrame:
    """Reports (corpus, fileCountWithinLimit, fileSizeWithinLimit, tokenCountWithinLimit) that say of themselves that a limit is broken."""
    broken = lambda *c: reduce(lambda x, y: x | y, (~F.coalesce(F.col(n), F.lit(False)) for n in c))
    return issues_of(validation.where(broken("fileCountWithinLimit", "fileSizeWithinLimit")), "merge_validation_failed", "corpus").unionByName(issues_of(validation.where(broken("tokenCountWithinLimit")), "merge_token_count_failed", "corpus"))


def index_issues(corpora: DataFrame, index: DataFrame, links: DataFrame, reported: DataFrame, found: DataFrame, anchors: DataFrame) -> DataFrame:
    """Indexes (corpus, text), their links (corpus, name, anchor), and files reported (corpus, name), found (corpus, name) and anchored (corpus, name, anchor)."""
    on = ["corpus", "name"]
    begun = index.where(F.col("text").startswith(F.concat(F.lit("# "), F.col("corpus"))))
    stale = _without(links, reported, on)
    known = links.join(reported.select(on).distinct(), on, "left_semi")
    return reduce(DataFrame.unionByName, [
        issues_of(_without(corpora, begun, ["corpus"]), "missing_embedded_index", "corpus"),
        issues_of(stale, "stale_index_file_link", "name"),
        issues_of(_without(known, found, on), "broken_index_file_link", "name"),
        issues_of(_without(known.join(found.select(on).distinct(), on, "left_semi"), anchors, [*on, "anchor"]), "broken_index_anchor", F.concat_ws("#", "name", "anchor")),
        issues_of(_without(reported, links, on), "unlinked_final_file", "name"),
    ])


def issue_counts(issues: DataFrame) -> DataFrame:
    """(errors, warnings, ok) of all issues."""
    return issues.agg(F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")).withColumn("ok", F.col("errors") == 0)


def rendered(issues: DataFrame) -> DataFrame:
    """(value): the issues as lines of Markdown, errors first."""
    rank = F.when(F.col("severity") == "error", 0).otherwise(1)
    line = F.concat(F.lit("- **"), F.upper("severity"), F.lit(" "), F.col("code"), F.lit(":** "), F.concat_ws(" ", "corpus", "subject"))
    return issues.orderBy(rank, "code", "corpus", "subject").select(line.alias("value"))


def decisions_report(works: DataFrame, portfolio: DataFrame, selected: DataFrame, excluded: DataFrame, staged: DataFrame) -> DataFrame:
    """(id, author, title, target, outcome, reason): what became of every work (id, author, title, target).

    ``portfolio`` (id, canonicalWorkId, reason), ``selected`` (id), ``excluded``
    (id, exclusionReason) and ``staged`` (id) hold one row per id at most.  An
    outcome is the first that holds of: other target, duplicate, selected,
    excluded, converted only, not converted.
    """
    mark = lambda d, name: d.select("id", F.lit(True).alias(name)).distinct()
    rows = works.join(portfolio.select("id", "canonicalWorkId", F.col("reason").alias("curated")), "id", "left").join(mark(selected, "in"), "id", "left").join(excluded.select("id", "exclusionReason"), "id", "left").join(mark(staged, "staged"), "id", "left")
    duplicate = F.coalesce(F.col("canonicalWorkId") != F.col("id"), F.lit(False))
    outcome = F.when(F.coalesce(F.col("target"), F.lit("null")) == "null", "outside").when(duplicate, "exact_duplicate").when(F.col("in"), "selected").when(F.col("exclusionReason").isNotNull(), "excluded").when(F.col("staged"), "converted").otherwise("not_converted")
    reason = F.when(duplicate, F.col("canonicalWorkId")).otherwise(F.coalesce("exclusionReason", "curated", F.lit("")))
    return rows.select("id", "author", "title", "target", outcome.alias("outcome"), reason.alias("reason"))
