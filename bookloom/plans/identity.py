"""Queries over names and identity: hints from paths, keys of works, groups of records, names of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.functions import identity as I
from bookloom.functions import keys as K
from bookloom.plans.works import files, format_rank
from bookloom.session import materialize
from bookloom.sources.tables import table

_CONFIDENCE = {"high": 3, "medium": 2, "low": 1}


def name_hints(spark: SparkSession, folder: str) -> DataFrame:
    """Author, title, cleaned name and folders that each file's metadata, name and path give."""
    rows = files(spark, folder).select("id", I.name_hints(F.col("relativePath"), F.col("metadata.title"), F.col("metadata.author")).alias("h"))
    return rows.select("id", "h.author", "h.title", "h.rawBase", "h.context")


def bundle_origins(spark: SparkSession, folder: str) -> DataFrame:
    """Whether each file comes from a folder that holds many works of one author."""
    return files(spark, folder).select("id", I.bundle_like(F.col("relativePath")).alias("bundleLike"))


def _responses(spark: SparkSession, folder: str) -> DataFrame:
    keep = ["author", "title", "language", "content_type", "target", "relevance_score", "priority_score", "confidence", "canonical_key", "evidence"]
    rows = table(spark, folder, "classifier_responses").where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classified_at", *keep)).alias("r"))
    return rows.select("id", *[f"r.{c}" for c in keep])


def canonical_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The key under which records of one work meet, and the last name of the first author."""
    key = I.canonical_key(F.col("canonical_key"), F.col("author"), F.col("title"), F.col("content_type"), F.lit(""))
    return _responses(spark, folder).select("id", key.alias("key"), I.lead_author(F.col("author")).alias("lead"), I.language_rank(F.col("language")).alias("languageRank"))


def _rank(column: Column) -> Column:
    return F.coalesce(*[F.when(column == k, v) for k, v in _CONFIDENCE.items()], F.lit(0))


def catalog_groups(spark: SparkSession, folder: str) -> DataFrame:
    """Records of one work, met by canonical key and then by shown author and title: the work's key, id, representative and flags.

    The representative is the most confident record, then that of greatest
    priority, relevance and evidence, then of smallest id.
    """
    rows = _responses(spark, folder).withColumn("key", I.canonical_key(F.col("canonical_key"), F.col("author"), F.col("title"), F.col("content_type"), F.lit("")))
    order = F.struct(*[(-x).alias(f"o{k}") for k, x in enumerate((_rank(F.col("confidence")), F.coalesce("priority_score", F.lit(-1)), F.coalesce("relevance_score", F.lit(-1)), I.evidence_rank(F.col("evidence"))))], "id", "author", "title", "content_type", "confidence")
    targets = F.collect_set(F.when(F.col("target").isin("corpus_a", "corpus_b"), F.col("target")))  # two values at most
    by_key = materialize(rows.groupBy("key").agg(F.min(order).alias("best"), F.count(F.lit(1)).alias("n"), targets.alias("targets")), "groups")
    shown = I.canonical_key(F.concat(I.lead_author(F.col("best.author")), F.lit(" | "), F.coalesce("best.title", F.lit(""))), F.col("best.author"), F.col("best.title"), F.col("best.content_type"), F.lit(""))
    marked = (F.col("best.content_type") == "article") & F.col("key").rlike(I.ARTICLE)
    shown = F.concat(shown, F.when(marked, "|marked-article").otherwise(""))
    works = by_key.groupBy(shown.alias("shown")).agg(F.min("best").alias("best"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("keys"), F.min("key").alias("key"), F.size(F.array_distinct(F.flatten(F.collect_set("targets")))).alias("targets"))
    final = F.when(F.col("keys") == 1, F.col("key")).otherwise(F.col("shown"))
    return works.select(final.alias("key"), K.stable_id("catalog", final).alias("workId"), F.col("best.id").alias("representative"), "members", "keys", (F.col("targets") > 1).alias("targetsDisagree"), (F.coalesce(F.col("best.confidence"), F.lit("")) == "low").alias("lowConfidence"))


def review_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Records to be looked at again: those of low confidence, and those that share a canonical key with others."""
    rows = materialize(_responses(spark, folder).select("id", "confidence", I.canonical_key(F.col("canonical_key"), F.col("author"), F.col("title"), F.col("content_type"), F.lit("")).alias("key")), "keys")
    shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    low = F.coalesce(F.col("confidence"), F.lit("")) == "low"
    out = rows.join(shared, "key", "left").where(low | F.col("members").isNotNull())
    return out.select("id", low.alias("lowConfidence"), F.coalesce("members", F.lit(1)).alias("members"))


def output_names(spark: SparkSession, folder: str) -> DataFrame:
    """The name of each work's file, made of author and title; equal names are told apart by the id."""
    best = F.array_min(F.transform("sourceVariants", lambda v: F.struct(format_rank(v["extension"]).alias("f"), v["extension"].alias("e"))))["e"]
    works = table(spark, folder, "catalog_works").groupBy("id").agg(F.max(F.struct("classifiedAt", "author", "title", F.coalesce(best, F.lit(".md")).alias("extension"))).alias("r"))
    named = works.select("id", I.output_name(F.col("r.author"), F.col("r.title"), F.col("r.extension")).alias("name"))
    return I.unique_names(named, "name", "id").select("id", "outputName", I.unit_anchor(F.col("id"), F.lit(1)).alias("anchor"))


QUERIES = {f.__name__: f for f in (name_hints, bundle_origins, canonical_keys, catalog_groups, review_candidates, output_names)}

_S = K.SPACE


def _squeezed(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_S}+', ' ', 'g'))"


def _bare(c: str) -> str:
    """Lower case without marks; signs that stand for digits and letters, as in text read in the wrong code page, are those."""
    for sign, plain in {"¼": "1/4", "½": "1/2", "¾": "3/4", "¹": "1", "²": "2", "³": "3", "ª": "a", "º": "o", "™": "tm", "…": "..."}.items():
        c = f"replace({c}, '{sign}', '{plain}')"
    return f"lower(strip_accents({c}))"


def _key(c: str) -> str:
    return f"trim(regexp_replace(replace({_bare(_squeezed(c))}, '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


def _hint(c: str) -> str:
    out = f"regexp_replace(regexp_replace(coalesce({c}, ''), '^title:\\s*', '', 'i'), '_+', ' ', 'g')"
    for tail in K.TITLE_TAILS:
        out = f"regexp_replace({out}, '{tail}', '')"
    return _squeezed(out)


def _edition_free(c: str) -> str:
    out = _key(c)
    for w in (r"(?:19|20)\d{2}", f"(?:{K.EDITION_WORDS})", f"(?:{K.PUBLISHERS})"):
        out = f"regexp_replace({out}, '\\b{w}\\b', ' ', 'g')"
    return f"trim(regexp_replace({out}, '\\s+', ' ', 'g'))"


def _useful(c: str, own: str) -> str:
    return f"CASE WHEN {_squeezed(c)} <> '' AND NOT regexp_matches({_squeezed(c)}, '(?i){K.EMPTY_METADATA}') AND NOT regexp_matches({_squeezed(c)}, '(?i){own}') THEN {_squeezed(c)} END"


_FILES = "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY scannedAt DESC, relativePath DESC) AS k FROM inventory_files) WHERE k = 1)"
_R = "r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY classified_at DESC NULLS LAST, author DESC NULLS LAST, title DESC NULLS LAST, language DESC NULLS LAST, content_type DESC NULLS LAST, target DESC NULLS LAST, relevance_score DESC NULLS LAST, priority_score DESC NULLS LAST) AS k FROM classifier_responses WHERE id IS NOT NULL) WHERE k = 1)"


def _lead(author: str) -> str:
    first = f"coalesce(list_filter(list_transform(regexp_split_to_array(regexp_replace({_bare(f"coalesce({author}, '')")}, '{I.EDITORS}', ' ', 'g'), '\\s+(?:and|a|&|et)\\s+|[;,]'), lambda p: trim(p)), lambda p: p <> '')[1], '')"
    return f"CASE WHEN {_key(first)} <> '' THEN string_split({_key(first)}, ' ')[-1] ELSE {first} END"


def _canonical(name: str, source: str, said: str, author: str, title: str, kind: str) -> str:
    """Steps of a WITH clause that add ``key`` to the rows of ``source``."""
    return f"""{name}1 AS (SELECT *, list_transform(string_split(coalesce({said}, ''), '|'), lambda p: {_squeezed('p')}) AS _parts, coalesce({author}, '') AS _a, coalesce({title}, '') AS _t FROM {source}),
{name}2 AS (SELECT *, CASE WHEN len(_parts) >= 2 THEN _parts[1] ELSE _a END AS _who, CASE WHEN len(_parts) >= 2 AND array_to_string(_parts[2:], ' | ') <> '' THEN array_to_string(_parts[2:], ' | ') ELSE _t END AS _what FROM {name}1),
{name}3 AS (SELECT *, array_to_string(list_sort(list_transform(list_filter(list_transform(regexp_split_to_array(_who, '{I.JOINTS}'), lambda a: trim(regexp_replace({_key('a')}, '{I.EDITORS}', ' ', 'g'))), lambda a: a <> ''), lambda a: regexp_split_to_array(a, ' +')[-1])), '+') AS _sig,
    list_filter(list_transform(regexp_split_to_array(_what, '{I.SUBTITLE}'), lambda p: trim(p)), lambda p: p <> '') AS _pieces FROM {name}2),
{name}4 AS (SELECT *, CASE WHEN {kind} = 'article' THEN CASE WHEN regexp_matches(_what, '{I.ARTICLE}') THEN _what ELSE _t END WHEN regexp_matches(_t, '{I.PARTIAL}') THEN _t
    WHEN len(_pieces) > 1 AND len(string_split(_pieces[1], ' ')) >= 3 AND NOT regexp_matches(array_to_string(_pieces[2:], ' '), '{I.VOLUME}') THEN _pieces[1] ELSE _what END AS _chosen FROM {name}3),
{name} AS (SELECT * EXCLUDE (_parts, _a, _t, _who, _what, _sig, _pieces, _chosen), CASE WHEN _sig <> '' THEN _sig ELSE {_key("CASE WHEN _who <> '' THEN _who ELSE _a END")} END || '|' || {_edition_free('_chosen')} AS key FROM {name}4)"""


_RANKS = "CASE {0} WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"
_EVIDENCE = "CASE {0} WHEN 'web_research' THEN 5 WHEN 'known_work' THEN 4 WHEN 'provided_metadata' THEN 3 WHEN 'path_or_filename' THEN 2 WHEN 'uncertain' THEN 1 ELSE 0 END"


def _part(c: str, most: int) -> str:
    out = f"regexp_replace({_squeezed(c)}, '[\\x{{00}}-\\x{{1F}}<>:\"/\\\\|?*]', ' ', 'g')"
    out = _squeezed(f"regexp_replace({out}, '\\.+$', '')")
    return f"trim(substr(CASE WHEN {out} = '' THEN 'Unknown' ELSE {out} END, 1, {most}))"


SQL = {
    "name_hints": f"""WITH {_FILES},
a AS (SELECT id, list_filter(string_split(regexp_extract(relativePath, '^(.*)/[^/]*$', 1), '/'), lambda p: p <> '' AND p <> '.') AS folders, {_useful('metadata.author', K.EMPTY_AUTHOR)} AS ma, {_useful('metadata.title', K.EMPTY_TITLE)} AS mt, {_hint("regexp_replace(regexp_extract(relativePath, '([^/]*)$', 1), '(.)[.][^.]*$', '\\1')")} AS base FROM f),
b AS (SELECT *, coalesce(folders[1], '') AS top, list_filter(list_transform(regexp_split_to_array(base, '\\s+-\\s+'), lambda p: {_squeezed('p')}), lambda p: p <> '') AS parts FROM a),
c AS (SELECT *, coalesce(ma, nullif(regexp_replace(regexp_extract(base, '{I.BRACKETED}', 1), '\\s*,\\s*', ', ', 'g'), ''), nullif(regexp_extract(base, '{I.BY}', 2), ''), CASE WHEN len(parts) >= 2 THEN parts[1] END,
    CASE WHEN regexp_matches(top, '{I.FOLDER_COUNT}') OR regexp_matches(top, '{I.FOLDER_NAME}') THEN regexp_replace(top, '\\s*\\([^)]*\\)\\s*$', '') ELSE nullif(regexp_extract(top, '{I.FOLDER_OF}', 1), '') END, '') AS whose,
    coalesce(mt, nullif(regexp_extract(base, '{I.BRACKETED}', 2), ''), nullif(regexp_extract(base, '{I.BY}', 1), ''), CASE WHEN len(parts) >= 2 THEN array_to_string(parts[2:], ' - ') END, base) AS what FROM b)
SELECT id, {_hint('whose')} AS author, {_hint('what')} AS title, base AS rawBase, coalesce(array_to_string(folders[greatest(len(folders) - 2, 1):], ' / '), '') AS context FROM c""",
    "bundle_origins": f"WITH {_FILES} SELECT id, regexp_matches(coalesce(list_filter(regexp_split_to_array(relativePath, '[\\\\/]'), lambda p: p <> '')[1], ''), '{I.BUNDLES}') AS bundleLike FROM f",
    "canonical_keys": f"WITH {_R}, {_canonical('k', 'r', 'canonical_key', 'author', 'title', 'content_type')} SELECT id, key, {_lead('author')} AS lead, CASE WHEN regexp_matches({_key('language')}, '{I.PREFERRED}') THEN 0 WHEN {_key('language')} IN ('', 'unknown', 'neznamy') THEN 1 ELSE 2 END AS languageRank FROM k",
    "catalog_groups": f"""WITH {_R}, {_canonical('c', 'r', 'canonical_key', 'author', 'title', 'content_type')},
o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY {_RANKS.format('confidence')} DESC, coalesce(priority_score, -1) DESC, coalesce(relevance_score, -1) DESC, {_EVIDENCE.format('evidence')} DESC, id) AS place, count(*) OVER (PARTITION BY key) AS n FROM c),
b AS (SELECT id, author, title, content_type, key AS own, n, {_lead('author')} || ' | ' || coalesce(title, '') AS said FROM o WHERE place = 1), {_canonical('d', 'b', 'said', 'author', 'title', 'content_type')},
s AS (SELECT own, key || CASE WHEN content_type = 'article' AND regexp_matches(own, '{I.ARTICLE}') THEN '|marked-article' ELSE '' END AS shown FROM d),
m AS (SELECT c.*, shown, row_number() OVER (PARTITION BY shown ORDER BY {_RANKS.format('confidence')} DESC, coalesce(priority_score, -1) DESC, coalesce(relevance_score, -1) DESC, {_EVIDENCE.format('evidence')} DESC, id) AS place FROM c JOIN s ON own = key),
g AS (SELECT shown, count(*) AS members, count(DISTINCT key) AS keys, min(key) AS key, count(DISTINCT CASE WHEN target IN ('corpus_a', 'corpus_b') THEN target END) > 1 AS targetsDisagree, max(CASE WHEN place = 1 THEN id END) AS representative, bool_or(place = 1 AND confidence IS NOT DISTINCT FROM 'low') AS lowConfidence FROM m GROUP BY shown)
SELECT CASE WHEN keys = 1 THEN key ELSE shown END AS key, 'catalog_' || substr(sha1(CASE WHEN keys = 1 THEN key ELSE shown END), 1, 16) AS workId, representative, members, keys, targetsDisagree, lowConfidence FROM g""",
    "review_candidates": f"""WITH {_R}, {_canonical('k', 'r', 'canonical_key', 'author', 'title', 'content_type')}, m AS (SELECT id, coalesce(confidence, '') = 'low' AS lowConfidence, count(*) OVER (PARTITION BY key) AS members FROM k)
SELECT id, lowConfidence, members FROM m WHERE lowConfidence OR members > 1""",
    "output_names": f"""WITH w AS (SELECT id, author, title, lower(coalesce(list_sort(list_transform(sourceVariants, lambda v: {{'f': CASE lower(v.extension) WHEN '.md' THEN 0 WHEN '.epub' THEN 1 WHEN '.pdf' THEN 2 ELSE 3 END, 'e': v.extension}}))[1].e, '.md')) AS e FROM catalog_works),
n AS (SELECT id, {_part(f"{_part('author', I.AUTHOR_CHARS)} || ' - ' || {_part('title', I.TITLE_CHARS)}", I.NAME_CHARS)} AS base, e FROM w), p AS (SELECT *, id = min(id) OVER (PARTITION BY lower(base || e)) AS own FROM n)
SELECT id, base || CASE WHEN own THEN '' ELSE ' [' || right(id, 8) || ']' END || e AS outputName, regexp_replace(substr(replace({_key('id')}, ' ', '-'), 1, 72), '-+$', '') || '-1' AS anchor FROM p""",
}
