"""Classifiers as plug-ins: any function from works to decisions, and one that looks decisions up."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a decision must say.
DECISION = ["source", "author", "title", "summary", "target", "confidence", "reason"]


class InvalidDecisions(ValueError):
    """Decisions that are missing, repeated, uncalled for or out of bounds."""


def id_problems(expected: DataFrame, actual: DataFrame, key: str = "source") -> DataFrame:
    """(key, problem): keys that are ``missing``, ``unexpected`` or ``repeated`` among ``actual``.  Null keys are unexpected."""
    want = expected.select(key).distinct().withColumn("_want", F.lit(True))
    have = actual.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    both = want.join(have, key, "full_outer")
    problem = F.when(F.col("_n").isNull(), "missing").when(F.col("_want").isNull(), "unexpected").when(F.col("_n") > 1, "repeated")
    return both.select(key, problem.alias("problem")).where("problem IS NOT NULL")


def invalid(decisions: DataFrame, targets: list[str]) -> DataFrame:
    """Decisions whose target is none of ``targets`` or whose confidence is not between 0 and 1, with ``problem``."""
    bad = F.when(~F.coalesce(F.col("target").isin(targets), F.lit(False)), "target").when(~F.coalesce(F.col("confidence").between(0, 1), F.lit(False)) | F.isnan(F.col("confidence").cast("double")), "confidence")
    return decisions.withColumn("problem", bad).where("problem IS NOT NULL")


def classified(works: DataFrame, classifier: Callable[[DataFrame], DataFrame], targets: list[str], key: str = "source") -> DataFrame:
    """The decisions of a classifier on ``works``; raises :class:`InvalidDecisions` unless each work has one that is valid."""
    decisions = classifier(works)
    for wrong in (id_problems(works, decisions, key), invalid(decisions, targets).select(key, "problem")):
        if some := wrong.limit(5).collect():
            raise InvalidDecisions("; ".join(f"{r[key]}: {r['problem']}" for r in some))
    return decisions


def classified_in_batches(works: DataFrame, classifier: Callable[[DataFrame], DataFrame], targets: list[str], place: str, size: int, key: str = "source") -> Iterator[DataFrame]:
    """Decisions batch by batch of ``size`` works in the order of ``place`` (numbers from 1); a batch that fails is halved until it succeeds.

    A single work that fails raises.  The caller writes each batch before it
    asks for the next, so that nothing is decided twice.
    """
    last = works.agg(F.max(place).alias("n")).first()["n"] or 0
    spans = [(a, min(a + size - 1, last)) for a in range(1, last + 1, size)]
    while spans:
        first, end = spans.pop(0)
        try:
            yield classified(works.where(F.col(place).between(first, end)), classifier, targets, key)
        except Exception:
            if first == end:
                raise
            middle = (first + end) // 2
            spans[:0] = [(first, middle), (middle + 1, end)]


def from_metadata(definitions: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """A classifier that takes each work's decision from ``definitions`` (``DECISION``); texts are trimmed, a missing title is the source's name."""
    base = F.regexp_replace(F.regexp_extract("source", r"([^/]*)$", 1), r"(.)\.[^.]*$", "$1")

    def decide(works: DataFrame) -> DataFrame:
        found = definitions.join(works.select("source").distinct(), "source", "left_semi")
        text = lambda c: F.trim(F.coalesce(c, F.lit("")))
        title = F.when(text("title") != "", text("title")).otherwise(base)
        return found.select("source", text("author").alias("author"), title.alias("title"), text("summary").alias("summary"), "target", F.col("confidence").cast("double").alias("confidence"), text("reason").alias("reason"), F.lit("user_metadata").alias("evidence"))

    return decide


def response_text(response: str = "response") -> Column:
    """The text of a JSON answer: its ``output_text``, else the first text of its outputs, else null."""
    shape = "struct<output_text: string, output: array<struct<content: array<struct<type: string, text: string>>>>>"
    r = F.from_json(response, shape)
    inner = F.filter(F.flatten(F.transform(r["output"], lambda o: F.coalesce(o["content"], F.array().cast("array<struct<type: string, text: string>>")))), lambda c: (c["type"] == "output_text") & (c["text"] != ""))
    return F.coalesce(F.when(r["output_text"] != "", r["output_text"]), F.get(inner, F.lit(0))["text"])


def summary(decisions: DataFrame, sources: DataFrame) -> DataFrame:
    """(target, works) of all sources, those without decision as ``unclassified``, and a row ``all`` with a fingerprint of the decisions."""
    rows = sources.select("source").distinct().join(decisions, "source", "left")
    by = rows.groupBy(F.coalesce("target", F.lit("unclassified")).alias("target")).agg(F.count(F.lit(1)).alias("works")).withColumn("fingerprint", F.lit(None).cast("string"))
    each = F.xxhash64(F.to_json(F.struct("source", "author", "title", "target", "confidence"), {"ignoreNullFields": "false"}))
    whole = decisions.agg(F.count(F.lit(1)).alias("works"), F.hex(F.bit_xor(each)).alias("fingerprint")).select(F.lit("all").alias("target"), "works", "fingerprint")
    return by.unionByName(whole)
