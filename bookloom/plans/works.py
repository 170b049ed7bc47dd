"""Queries over scanned files and catalogued works: keys, identity, merging, ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookloom.functions import keys as K
from bookloom.operators.graph import components, star_edges
from bookloom.operators.matching import assign_once
from bookloom.plans.sql import contributor_steps
from bookloom.session import materialize
from bookloom.sources.tables import table

# File formats from the preferred to the least, and traces of copies in a path.
FORMATS = [".md", ".epub", ".pdf"]
COPY = r"(?i)(?:\bcopy\b|\(\d+\)|download)"
#: Scans before this time make up the earlier snapshot.
EARLIER = "2024-10-01"


def format_rank(extension: Column) -> Column:
    """Place of a format among the preferred ones, the last place for others."""
    return F.coalesce(*[F.when(F.lower(extension) == f, i) for i, f in enumerate(FORMATS)], F.lit(len(FORMATS)))


def files(spark: SparkSession, folder: str, before: str | None = None) -> DataFrame:
    """One row per file id: the latest scan, of those before a time if one is given."""
    rows = table(spark, folder, "inventory_files")
    if before:
        rows = rows.where(F.col("scannedAt") < F.lit(before).cast("timestamp"))
    keep = ["relativePath", "extension", "size", "sha256", "workHintKey", "metadata", "hints"]
    return rows.where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("scannedAt", *keep)).alias("r")).select("id", *[F.col(f"r.{c}").alias(c) for c in keep])


def inventory_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Files, bytes, copies and files per format."""
    ext = F.lower("extension")
    rows = table(spark, folder, "inventory_files").groupBy("id").agg(F.max(F.struct("scannedAt", "size", "sha256", ext.alias("ext"))).alias("r"))
    by = [F.count_if(F.col("r.ext") == f).alias(f"files_{f[1:]}") for f in FORMATS]
    return rows.agg(F.count(F.lit(1)).alias("fileCount"), F.sum("r.size").alias("totalBytes"), (F.count("r.sha256") - F.countDistinct("r.sha256")).alias("exactDuplicateCount"), *by)


def ascii_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Key and slug of every typed title."""
    key = K.ascii_key(F.col("title"))
    return table(spark, folder, "classifier_responses").select("id", key.alias("titleKey")).distinct().withColumn("slug", K.slug(F.col("titleKey")))


def creator_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of all contributors of a byline, in order, and the leading one."""
    rows = table(spark, folder, "catalog_works").select("id", F.posexplode_outer(K.contributors(F.col("author"))).alias("place", "name"))
    keyed = rows.withColumn("key", F.when(F.col("name").isNotNull(), K.ascii_key(K.given_first(F.col("name"))))).withColumn("key", F.when(F.col("key") != "", F.col("key")))
    lists = keyed.groupBy("id").agg(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("place", "key")))), lambda s: s["key"])).alias("k"))
    return lists.select("id", F.array_join("k", "; ").alias("creators"), F.coalesce(F.get("k", F.lit(0)), F.lit("unknown")).alias("lead"))


def hint_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Work keys recomputed from the name hints of each file, beside the stored ones."""
    rows = files(spark, folder).select("id", "workHintKey", K.ascii_key(F.col("hints.author")).alias("a"), K.edition_free(K.ascii_key(K.title_hint(F.col("hints.title")))).alias("t"))
    return rows.select("id", K.work_hint_key(F.col("a"), F.col("t")).alias("key"), "workHintKey").withColumn("same", F.col("key") == F.col("workHintKey"))


def useful_fields(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a file's title and author metadata say anything."""
    return files(spark, folder).select("id", *[K.useful_metadata(F.col(f"metadata.{k}"), k).alias(f"{k}Useful") for k in ("title", "author")])


def file_components(spark: SparkSession, folder: str) -> DataFrame:
    """Files of one work: tied, also through others, by equal bytes or an equal key of author and title."""
    return _candidates(files(spark, folder))


def _candidates(rows: DataFrame) -> DataFrame:
    keyed = rows.where("sha256 IS NOT NULL").select(F.col("id").alias("node"), F.concat(F.lit("s:"), "sha256").alias("key"))
    keyed = keyed.unionByName(rows.where("workHintKey <> ''").select(F.col("id").alias("node"), F.concat(F.lit("k:"), "workHintKey").alias("key")))
    tied = components(star_edges(keyed)).select(F.col("node").alias("id"), "component")
    return rows.select("id").join(tied, "id", "left").select("id", F.coalesce("component", "id").alias("candidate"))


def best_variant(spark: SparkSession, folder: str) -> DataFrame:
    """The file each candidate work is read from: preferred format, no copy, the largest, the first path; and its variants."""
    rows = files(spark, folder).join(file_components(spark, folder), "id")
    order = F.struct(format_rank(F.col("extension")).alias("f"), F.when(F.col("relativePath").rlike(COPY), 1).otherwise(0).alias("c"), (-F.col("size")).alias("s"), "relativePath", "id")
    out = rows.groupBy("candidate").agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("variants"), F.countDistinct("sha256").alias("contents"))
    return out.select("candidate", F.col("o.id").alias("primaryFile"), "variants", "contents")


def snapshot_reuse(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the later scans against the earlier ones: new, changed or unchanged in size and time."""
    rows = table(spark, folder, "inventory_files").where("id IS NOT NULL").select("id", "size", "mtimeMs", "scannedAt", F.year("scannedAt").alias("y"), F.month("scannedAt").alias("m"))
    early = F.col("scannedAt") < F.lit(EARLIER).cast("timestamp")
    last = lambda d: d.groupBy("id").agg(F.max(F.struct("scannedAt", "size", "mtimeMs")).alias("r")).select("id", F.col("r.size").alias("size"), F.col("r.mtimeMs").alias("mtime"))
    old, new = last(rows.where(early)), last(rows.where(~early))
    joined = new.join(old.select("id", F.col("size").alias("s0"), F.col("mtime").alias("m0")), "id", "left")
    state = F.when(F.col("s0").isNull(), "new").when((F.col("s0") == F.col("size")) & (F.abs(F.col("m0") - F.col("mtime")) < 1), "unchanged").otherwise("changed")
    return joined.select("id", state.alias("state"))


def previous_ids(spark: SparkSession, folder: str) -> DataFrame:
    """For each candidate of all files the candidate of the earlier snapshot whose id it keeps, and the files they share; null and 0 where it keeps none.

    Candidates come in the order of their first paths; each takes the id it
    shares most files with (the smaller id if equal) of those not yet taken.
    """
    rows = materialize(files(spark, folder).select("id", "relativePath", "sha256", "workHintKey"), "files")
    now = materialize(rows.select("id", "relativePath").join(_candidates(rows), "id"), "now")
    before = _candidates(files(spark, folder, EARLIER)).select("id", F.col("candidate").alias("previous"))
    order = now.groupBy("candidate").agg(F.min(F.struct("relativePath", "id")).alias("place"))
    shared = now.join(before, "id").groupBy("candidate", "previous").agg(F.count(F.lit(1)).alias("files")).join(order, "candidate")
    kept = assign_once(shared, "candidate", "previous", "files", "place")
    return order.select("candidate").join(kept, "candidate", "left").select("candidate", "previous", F.coalesce("files", F.lit(0)).alias("files"))


def _confidence(column: str) -> Column:
    return F.when(F.col(column) == "high", 3).when(F.col(column) == "medium", 2).when(F.col(column) == "low", 1).otherwise(0)


def catalog_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Works of one canonical key: members, the record that stands for them, and whether their targets disagree."""
    rows = table(spark, folder, "catalog_works").where("trim(canonicalKey) <> ''").withColumn("key", F.lower(F.trim("canonicalKey")))
    order = F.struct(-_confidence("confidence"), -F.coalesce("priorityScore", F.lit(-1)), -F.coalesce("relevanceScore", F.lit(-1)), F.col("id").alias("id"))
    targets = F.countDistinct(F.when(F.col("target") != "null", F.col("target")))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.min(order)["id"].alias("representative"), (targets > 1).alias("targetsDisagree"))


def catalog_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Works, mean scores and flagged works per target and content type, with totals."""
    rows = table(spark, folder, "catalog_works").select("target", F.coalesce("contentType", F.lit("none")).alias("contentType"), "priorityScore", "relevanceScore", F.size("reviewFlags").alias("flags"))
    out = rows.rollup("target", "contentType").agg(F.count(F.lit(1)).alias("works"), F.round(F.avg("priorityScore"), 4).alias("priority"), F.round(F.avg("relevanceScore"), 4).alias("relevance"), F.count_if(F.col("flags") > 0).alias("flagged"))
    return out.select(F.coalesce("target", F.lit("all")).alias("target"), F.coalesce("contentType", F.lit("all")).alias("contentType"), "works", "priority", "relevance", "flagged")


def classification_coverage(spark: SparkSession, folder: str) -> DataFrame:
    """Files named by works but not scanned, scanned but not named, and both."""
    named = table(spark, folder, "catalog_works").select(F.explode("sourceVariants.fileId").alias("id")).distinct().withColumn("named", F.lit(1))
    both = table(spark, folder, "inventory_files").select("id").distinct().withColumn("scanned", F.lit(1)).join(named, "id", "full_outer")
    return both.select(F.when(F.col("named").isNull(), "unnamed").when(F.col("scanned").isNull(), "missing").otherwise("matched").alias("state")).groupBy("state").agg(F.count(F.lit(1)).alias("files"))


def catalog_variant(spark: SparkSession, folder: str) -> DataFrame:
    """The source variant a work is best read from: language, format, priority, confidence, size, path."""
    v = table(spark, folder, "catalog_works").select("id", F.explode("sourceVariants").alias("v")).select("id", "v.*")
    tongue = F.when(F.col("classificationLanguage").isin("cs", "en"), 0).when(F.coalesce(F.trim("classificationLanguage"), F.lit("")) == "", 1).otherwise(2)
    order = F.struct(tongue, format_rank(F.col("extension")), -F.coalesce("classificationPriorityScore", F.lit(-1)), -_confidence("classificationConfidence"), -F.col("size"), F.col("relativePath").alias("path"), F.col("fileId").alias("file"))
    return v.groupBy("id").agg(F.min(order)["file"].alias("fileId"), F.count(F.lit(1)).alias("variants"), F.sum("size").alias("bytes"))


def author_overview(spark: SparkSession, folder: str) -> DataFrame:
    """Creators with their works, mean priority, and their eight first titles by priority."""
    rows = table(spark, folder, "catalog_works").select("id", "title", F.coalesce("priorityScore", F.lit(-1)).alias("p"), F.lower(F.trim("author")).alias("author")).where("author <> ''")
    # eight titles of each creator in each of 16 parts, then eight of those: no creator is one task's work
    part = F.pmod(F.xxhash64("id"), F.lit(16))
    w = lambda *k: Window.partitionBy(*k).orderBy(F.col("p").desc(), "id")
    top = rows.where("title IS NOT NULL").withColumn("part", part).withColumn("k", F.row_number().over(w("author", "part"))).where("k <= 8").withColumn("k", F.row_number().over(w("author"))).where("k <= 8")
    titles = top.groupBy("author").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "title"))), lambda s: s["title"]), " | ").alias("titles"))
    return rows.groupBy("author").agg(F.count(F.lit(1)).alias("works"), F.round(F.avg(F.when(F.col("p") >= 0, F.col("p"))), 4).alias("priority")).join(titles, "author", "left")


QUERIES = {f.__name__: f for f in (inventory_summary, ascii_keys, creator_keys, hint_keys, useful_fields, file_components, best_variant, snapshot_reuse, previous_ids, catalog_merge, catalog_summary, classification_coverage, catalog_variant, author_overview)}

_S = K.SPACE


def _squeezed(c: str) -> str:
    return f"trim(regexp_replace(coalesce({c}, ''), '{_S}+', ' ', 'g'))"


def _key(c: str) -> str:
    return f"trim(regexp_replace(replace(lower(strip_accents({_squeezed(c)})), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"


_FILES = "f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY scannedAt DESC, relativePath DESC) AS k FROM inventory_files) WHERE k = 1)"
_COMPONENTS = f"""RECURSIVE {_FILES},
ties AS (SELECT a.id AS x, b.id AS y FROM f a JOIN f b ON a.sha256 = b.sha256 UNION SELECT a.id, b.id FROM f a JOIN f b ON a.workHintKey = b.workHintKey WHERE a.workHintKey <> ''),
reach AS (SELECT x, y FROM ties UNION SELECT r.x, t.y FROM reach r JOIN ties t ON r.y = t.x),
c AS (SELECT f.id, coalesce(min(y), f.id) AS candidate FROM f LEFT JOIN reach ON x = f.id GROUP BY f.id)"""
_RANK = "CASE lower({0}) WHEN '.md' THEN 0 WHEN '.epub' THEN 1 WHEN '.pdf' THEN 2 ELSE 3 END"
_CONF = "CASE {0} WHEN 'high' THEN 3 WHEN 'medium' THEN 2 WHEN 'low' THEN 1 ELSE 0 END"
_TITLE = "regexp_replace(regexp_replace(coalesce(hints.title, ''), '^title:\\s*', '', 'i'), '_+', ' ', 'g')"
for _tail in K.TITLE_TAILS:
    _TITLE = f"regexp_replace({_TITLE}, '{_tail}', '')"
_FREE = _key("ttl")
for _w in (r"(?:19|20)\d{2}", f"(?:{K.EDITION_WORDS})", f"(?:{K.PUBLISHERS})"):
    _FREE = f"regexp_replace({_FREE}, '\\b{_w}\\b', ' ', 'g')"
_FREE = f"trim(regexp_replace({_FREE}, '\\s+', ' ', 'g'))"


def _useful(field: str, own: str) -> str:
    t = _squeezed(f"metadata.{field}")
    return f"({t} <> '' AND NOT regexp_matches({t}, '(?i){K.EMPTY_METADATA}') AND NOT regexp_matches({t}, '(?i){own}'))"


_KEYS = "list_filter(nameKeys, lambda x: x <> '')"
SQL = {
    "creator_keys": f"WITH {contributor_steps('c', 'catalog_works')} SELECT id, coalesce(array_to_string(list_filter({_KEYS}, lambda x, i: list_position({_KEYS}, x) = i), '; '), '') AS creators, coalesce({_KEYS}[1], 'unknown') AS lead FROM c3",
    "inventory_summary": f"WITH {_FILES} SELECT count(*) AS fileCount, sum(size) AS totalBytes, count(sha256) - count(DISTINCT sha256) AS exactDuplicateCount, " + ", ".join(f"count_if(lower(extension) = '{x}') AS files_{x[1:]}" for x in FORMATS) + " FROM f",
    "ascii_keys": f"SELECT DISTINCT id, titleKey, regexp_replace(substr(replace(titleKey, ' ', '-'), 1, 72), '-+$', '') AS slug FROM (SELECT id, {_key('title')} AS titleKey FROM classifier_responses)",
    "hint_keys": f"""WITH {_FILES}, t AS (SELECT id, workHintKey, {_key('hints.author')} AS a, {_squeezed(_TITLE)} AS ttl FROM f), e AS (SELECT id, workHintKey, a, {_FREE} AS t FROM t),
k AS (SELECT id, workHintKey, CASE WHEN length(t) < 8 OR (a = '' AND len(string_split(t, ' ')) < 4) THEN '' ELSE a || '|' || t END AS key FROM e) SELECT id, key, workHintKey, key = workHintKey AS same FROM k""",
    "useful_fields": f"WITH {_FILES} SELECT id, {_useful('title', K.EMPTY_TITLE)} AS titleUseful, {_useful('author', K.EMPTY_AUTHOR)} AS authorUseful FROM f",
    "file_components": f"WITH {_COMPONENTS} SELECT id, candidate FROM c",
    "best_variant": f"""WITH {_COMPONENTS} SELECT candidate, arg_min(id, row({_RANK.format('extension')}, CAST(regexp_matches(relativePath, '{COPY}') AS INT), -size, relativePath, id)) AS primaryFile, count(*) AS variants, count(DISTINCT sha256) AS contents
FROM f JOIN c USING (id) GROUP BY candidate""",
    "snapshot_reuse": """WITH l AS (SELECT id, scannedAt < TIMESTAMPTZ '2024-10-01 00:00:00+00' AS early, arg_max(size, row(scannedAt, size, mtimeMs)) AS size, arg_max(mtimeMs, row(scannedAt, size, mtimeMs)) AS mtime FROM inventory_files GROUP BY 1, 2)
SELECT n.id, CASE WHEN o.id IS NULL THEN 'new' WHEN o.size = n.size AND abs(o.mtime - n.mtime) < 1 THEN 'unchanged' ELSE 'changed' END AS state FROM l n LEFT JOIN l o ON o.id = n.id AND o.early WHERE NOT n.early""",
    "catalog_merge": f"""SELECT key, count(*) AS members, arg_min(id, row(-{_CONF.format('confidence')}, -coalesce(priorityScore, -1), -coalesce(relevanceScore, -1), id)) AS representative, count(DISTINCT CASE WHEN target <> 'null' THEN target END) > 1 AS targetsDisagree
FROM (SELECT *, lower(trim(canonicalKey)) AS key FROM catalog_works WHERE trim(canonicalKey) <> '') GROUP BY key""",
    "catalog_summary": """SELECT coalesce(target, 'all') AS target, coalesce(contentType, 'all') AS contentType, count(*) AS works, round(avg(priorityScore), 4) AS priority, round(avg(relevanceScore), 4) AS relevance, count_if(len(reviewFlags) > 0) AS flagged
FROM (SELECT target, coalesce(contentType, 'none') AS contentType, priorityScore, relevanceScore, reviewFlags FROM catalog_works) GROUP BY ROLLUP (target, contentType)""",
    "classification_coverage": """WITH n AS (SELECT DISTINCT v.fileId AS id FROM (SELECT unnest(sourceVariants) AS v FROM catalog_works)), s AS (SELECT DISTINCT id FROM inventory_files)
SELECT CASE WHEN n.id IS NULL THEN 'unnamed' WHEN s.id IS NULL THEN 'missing' ELSE 'matched' END AS state, count(*) AS files FROM n FULL JOIN s ON n.id = s.id GROUP BY 1""",
    "catalog_variant": f"""SELECT id, arg_min(v.fileId, row(CASE WHEN v.classificationLanguage IN ('cs', 'en') THEN 0 WHEN coalesce(trim(v.classificationLanguage), '') = '' THEN 1 ELSE 2 END, {_RANK.format('v.extension')}, -coalesce(v.classificationPriorityScore, -1),
    -{_CONF.format('v.classificationConfidence')}, -v.size, v.relativePath, v.fileId)) AS fileId, count(*) AS variants, sum(v.size) AS bytes FROM (SELECT id, unnest(sourceVariants) AS v FROM catalog_works) GROUP BY id""",
    "author_overview": """WITH r AS (SELECT id, title, coalesce(priorityScore, -1) AS p, lower(trim(author)) AS author FROM catalog_works WHERE trim(author) <> ''),
t AS (SELECT author, string_agg(title, ' | ' ORDER BY k) AS titles FROM (SELECT author, title, row_number() OVER (PARTITION BY author ORDER BY p DESC, id) AS k FROM r WHERE title IS NOT NULL) WHERE k <= 8 GROUP BY author)
SELECT r.author, count(*) AS works, round(avg(CASE WHEN p >= 0 THEN p END), 4) AS priority, any_value(titles) AS titles FROM r LEFT JOIN t ON t.author = r.author GROUP BY r.author""",
}
