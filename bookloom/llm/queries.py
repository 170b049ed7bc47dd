"""The queries of the nine training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.llm import caps, mix, names, pack, paragraphs, quality, scans, spans, split, survivor
from bookloom.session import materialize
from bookloom.sources.tables import table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return names.Variants(table(spark, folder, "classifier_responses")).found()


def p1_classes(spark: SparkSession, folder: str) -> DataFrame:
    return names.Variants(table(spark, folder, "classifier_responses")).classes()


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return scans.Scans(table(spark, folder, "book_units")).found()


def p2_repaired(spark: SparkSession, folder: str) -> DataFrame:
    return scans.Scans(table(spark, folder, "book_units")).repaired()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return survivor.undisputed(table(spark, folder, "catalog_works"))


def p3_golden_records(spark: SparkSession, folder: str) -> DataFrame:
    return survivor.golden_records(table(spark, folder, "catalog_works"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return caps.cap_decisions(table(spark, folder, "curated_works")).where("NOT kept").select("runId", "id")


def p4_stratified_cap(spark: SparkSession, folder: str) -> DataFrame:
    out = caps.cap_decisions(table(spark, folder, "curated_works"), exponent=0.5)
    return out.select("runId", "corpus", "creator", "stratum", "slots", "place", "kept", "id")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    units = split.current_units(table(spark, folder, "book_units"))
    limits = table(spark, folder, "upload_limits").where("profile = 'large'")
    cut = split.cut_units(units, limits, text=False).where("pieces > 1 AND piece = 1")
    kinds = F.array_compact(F.array(F.lit("unit"), F.when(F.col("blockBytes") > split.LIMIT_BYTES, "block")))
    return cut.select("workId", "unitIndex", F.explode(kinds).alias("kind"))


def p5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return split.split_units(table(spark, folder, "book_units"), table(spark, folder, "upload_limits"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.LineModel.fitted(*quality.labelled_sample(docs, table(spark, folder, "quality_labels")))
    return quality.quality(docs, model)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    measured = materialize(_quality(spark, folder).select("doc_id", "kind", "words", "replacementCharacters"), "quality")
    kinds = measured.where(F.col("kind").isin("list", "table", "junk")).select("doc_id", "kind")
    stale = quality.stale_audits(measured, table(spark, folder, "quality_audit")).withColumn("kind", F.lit("stale"))
    return kinds.unionByName(stale).distinct()


def p6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return _quality(spark, folder)


def p6_audit(spark: SparkSession, folder: str) -> DataFrame:
    return quality.audit_differences(_quality(spark, folder), table(spark, folder, "quality_audit"))


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    return pack.pack(table(spark, folder, "documents").select("doc_id", "corpus", "text"), table(spark, folder, "upload_limits"))


def p7_certificate(spark: SparkSession, folder: str) -> DataFrame:
    return pack.certificate(materialize(p7_containers(spark, folder), "containers"), table(spark, folder, "upload_limits"))


def _mix(spark: SparkSession, folder: str) -> mix.Mix:
    return mix.Mix(table(spark, folder, "documents").select("doc_id", "source", "text"), table(spark, folder, "mix_targets"))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder).rows()


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mix(spark, folder).shares()


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spans.SharedSpans(table(spark, folder, "documents").select("doc_id", "text")).pairs()


def p9_shared_part(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spans.SharedSpans(docs, hot=spans.FEW).shares(docs)


def p9_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return paragraphs.Paragraphs(docs).shares(docs)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query of this subpackage by its name."""
    found = [p1_found, p1_classes, p2_found, p2_repaired, p3_found, p3_golden_records, p4_found, p4_stratified_cap, p5_found, p5_pieces, p6_found, p6_quality, p6_audit, p7_containers, p7_certificate, p8_mix, p8_shares, p9_found, p9_shared_part, p9_paragraphs]
    return {f.__name__: f for f in found}
