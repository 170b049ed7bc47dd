"""A curator's statements about works, kept where they refer to what exists, with a warning for each that does not."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.operators.graph import components, star_edges

#: Areas a curator must name at least.
LEAST_AREAS = 3


@dataclass
class Atlas:
    """must (work_id, reason), policies (author_key, preferred_work_ids, soft_maximum), duplicates (representative_work_id, work_ids), containment (container_work_id, contained_work_id), areas (key, weight)."""

    must: DataFrame
    policies: DataFrame
    duplicates: DataFrame
    containment: DataFrame
    areas: DataFrame


def _warning(rows: DataFrame, code: str, subject: Column, value: Column) -> DataFrame:
    return rows.select(F.lit(code).alias("code"), subject.cast("string").alias("subject"), value.cast("string").alias("value"))


def checked_areas(atlas: Atlas) -> None:
    """Raises where fewer than ``LEAST_AREAS`` areas, or an area twice, are named."""
    found = atlas.areas.agg(F.count("key").alias("n"), F.countDistinct("key").alias("d")).first()
    if found["n"] < LEAST_AREAS or found["n"] != found["d"]:
        raise ValueError(f"{found['n']} areas, {found['d']} different ones")


def repaired_atlas(atlas: Atlas, works: DataFrame, contributors: DataFrame) -> tuple[Atlas, DataFrame]:
    """(atlas without what refers to nothing, warnings (code, subject, value)).

    ``works`` holds id; ``contributors`` (id, key), one row for each contributor
    of a work.  Works a policy prefers must be by its author; a group of
    duplicates is kept whole or not at all: all its works exist, are two at
    least and hold the representative; containment is between two works.  Nulls
    refer to nothing.
    """
    ids = works.select("id").where("id IS NOT NULL").distinct()
    named = lambda c: ids.select(F.col("id").alias(c))
    warnings = [_warning(atlas.must.join(named("work_id"), "work_id", "left_anti"), "unknown_must_include_work", F.col("work_id"), F.col("work_id"))]
    must = atlas.must.join(named("work_id"), "work_id", "left_semi")

    keys = contributors.select(F.col("key").alias("author_key")).distinct()
    warnings.append(_warning(atlas.policies.join(keys, "author_key", "left_anti"), "unknown_author_policy", F.col("author_key"), F.col("author_key")))
    policies = atlas.policies.join(keys, "author_key", "left_semi")
    wanted = policies.select("author_key", F.explode(F.array_distinct("preferred_work_ids")).alias("work_id"))
    warnings.append(_warning(wanted.join(named("work_id"), "work_id", "left_anti"), "unknown_preferred_work", F.col("author_key"), F.col("work_id")))
    there = wanted.join(named("work_id"), "work_id", "left_semi")
    by = contributors.select(F.col("id").alias("work_id"), F.col("key").alias("author_key")).distinct()
    warnings.append(_warning(there.join(by, ["work_id", "author_key"], "left_anti"), "wrong_author_preferred_work", F.col("author_key"), F.col("work_id")))
    good = there.join(by, ["work_id", "author_key"], "left_semi").groupBy("author_key").agg(F.array_sort(F.collect_set("work_id")).alias("good"))
    policies = policies.join(good, "author_key", "left").withColumn("preferred_work_ids", F.coalesce("good", F.array().cast("array<string>"))).drop("good")

    groups = atlas.duplicates.withColumn("work_ids", F.array_distinct("work_ids"))
    members = groups.select("representative_work_id", F.explode_outer("work_ids").alias("work_id")).join(ids.select(F.col("id").alias("work_id"), F.lit(1).alias("known")), "work_id", "left")
    unknown = members.groupBy("representative_work_id").agg(F.array_sort(F.collect_set(F.when(F.col("known").isNull(), F.col("work_id")))).alias("unknown"), F.count_if(F.col("known").isNull()).alias("lost"))
    judged = groups.join(unknown, "representative_work_id", "left")
    whole = (F.coalesce("lost", F.lit(1)) == 0) & (F.size("work_ids") >= 2) & F.array_contains("work_ids", F.col("representative_work_id"))
    warnings.append(_warning(judged.where(~F.coalesce(whole, F.lit(False))), "invalid_duplicate_group", F.col("representative_work_id"), F.array_join("unknown", ",")))
    duplicates = judged.where(F.coalesce(whole, F.lit(False))).select(groups.columns)

    ends = atlas.containment.where("container_work_id != contained_work_id").join(named("container_work_id"), "container_work_id", "left_semi").join(named("contained_work_id"), "contained_work_id", "left_semi").select("container_work_id", "contained_work_id").distinct()
    bad = atlas.containment.join(ends, ["container_work_id", "contained_work_id"], "left_anti")
    warnings.append(_warning(bad, "invalid_containment_relation", F.col("container_work_id"), F.col("contained_work_id")))
    containment = atlas.containment.join(ends, ["container_work_id", "contained_work_id"], "left_semi")
    return Atlas(must, policies, duplicates, containment, atlas.areas), reduce(DataFrame.unionByName, warnings)


#: Least length of a key that says something.
LEAST_KEY = 3


def repaired_decisions(decisions: DataFrame, rosters: DataFrame, areas: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(decisions that refer to nothing unknown, warnings (code, subject, value)).

    ``decisions``: id, identity_group_key, edition_group_key, canonical_work_id,
    contains_work_ids, contained_by_work_ids, topic_keys; one row per id.
    ``rosters`` (id, member) lists the works that a decision may name; ``areas``
    (key) the known topics.  Keys shorter than ``LEAST_KEY`` become the work's
    own, an unknown canonical work becomes the work itself, and unknown topics
    and works, and the work itself, are left out of lists.  Lists come out
    sorted and without repeats; null lists are empty.
    """
    warnings = []
    fixed = decisions
    for column, prefix, code in (("identity_group_key", "work-", "empty_identity_group_key"), ("edition_group_key", "edition-", "empty_edition_group_key")):
        short = F.length(F.trim(F.coalesce(column, F.lit("")))) < LEAST_KEY
        warnings.append(_warning(decisions.where(short), code, F.col("id"), F.col(column)))
        fixed = fixed.withColumn(column, F.when(short, F.concat(F.lit(prefix), "id")).otherwise(F.col(column)))
    known = rosters.select("id", F.col("member").alias("value")).distinct()
    named = decisions.select("id", F.col("canonical_work_id").alias("value"))
    warnings.append(_warning(named.join(known, ["id", "value"], "left_anti"), "unknown_canonical_work", F.col("id"), F.col("value")))
    good = named.join(known, ["id", "value"], "left_semi").withColumnRenamed("value", "_canonical")
    fixed = fixed.join(good, "id", "left").withColumn("canonical_work_id", F.coalesce("_canonical", "id")).drop("_canonical")
    lists = {"contains_work_ids": "invalid_contains_relation", "contained_by_work_ids": "invalid_contained_by_relation", "topic_keys": "unknown_topic_key"}
    for column, code in lists.items():
        each = decisions.select("id", F.explode(F.array_distinct(column)).alias("value"))
        own = each.join(areas.select(F.col("key").alias("value")).distinct(), "value", "left_semi") if column == "topic_keys" else each.where("id != value").join(known, ["id", "value"], "left_semi")
        own = own.select("id", "value")
        warnings.append(_warning(each.join(own, ["id", "value"], "left_anti"), code, F.col("id"), F.col("value")))
        fixed = fixed.join(own.groupBy("id").agg(F.array_sort(F.collect_set("value")).alias("_list")), "id", "left").withColumn(column, F.coalesce("_list", F.array().cast("array<string>"))).drop("_list")
    return fixed.select(decisions.columns), reduce(DataFrame.unionByName, warnings)


def identity_components(works: DataFrame, duplicates: DataFrame | None = None) -> DataFrame:
    """(id, component): of works (id, creator, canonicalWorkId, key) those that are one work, by the smallest id.

    Tied are two works of one creator of which one names the other as canonical
    or that have one ``key`` (null ties nothing), and all works of a group of
    ``duplicates`` (work_ids), whoever made them; works that are not there tie
    nothing.
    """
    other = works.select(F.col("id").alias("canonicalWorkId"), F.col("creator").alias("theirs"))
    edges = works.join(other, "canonicalWorkId").where("creator = theirs AND id != canonicalWorkId").select(F.col("id").alias("a"), F.col("canonicalWorkId").alias("b"))
    edges = edges.unionByName(star_edges(works.where("key IS NOT NULL").select(F.col("id").alias("node"), F.concat_ws("|", "creator", "key").alias("key"))))
    if duplicates is not None:
        groups = duplicates.select(F.array_min("work_ids").alias("key"), F.explode("work_ids").alias("node"))
        edges = edges.unionByName(star_edges(groups.join(works.select(F.col("id").alias("node")), "node", "left_semi")))
    tied = components(edges).select(F.col("node").alias("id"), "component")
    return works.select("id").join(tied, "id", "left").select("id", F.coalesce("component", "id").alias("component"))


def required_reasons(atlas: Atlas, representatives: DataFrame) -> DataFrame:
    """(id, reason): representatives that must be included, with the different reasons of their members in order, parted by a space.

    ``representatives``: id, representative.  A work without one stands for itself.
    """
    rows = atlas.must.join(representatives.withColumnRenamed("id", "work_id"), "work_id", "left").select(F.coalesce("representative", "work_id").alias("id"), "work_id", "reason")
    parts = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("work_id", "reason"))), lambda s: s["reason"]))
    return rows.groupBy("id").agg(F.array_join(parts, " ").alias("reason"))


def fingerprints(works: DataFrame, id_: str, fields: list[str]) -> DataFrame:
    """(id, fingerprint): SHA-256 of a work's fields as JSON, nulls included."""
    return works.select(F.col(id_).alias("id"), F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256).alias("fingerprint"))


def additions(saved: DataFrame, now: DataFrame) -> DataFrame:
    """(id, state): works of ``now`` and ``saved`` (id, fingerprint): ``added``, ``changed``, ``gone`` or ``same``.

    What was made from ``saved`` still holds where nothing is changed or gone.
    """
    both = now.withColumnRenamed("fingerprint", "new").join(saved.withColumnRenamed("fingerprint", "old"), "id", "full_outer")
    return both.select("id", F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "gone").when(F.col("old") == F.col("new"), "same").otherwise("changed").alias("state"))
