"""Queries over the curated works of a catalogue: identity, representatives, relations, rosters, batches, the conversion frontier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bookloom.functions import keys as K
from bookloom.operators import closure
from bookloom.operators.atlas import LEAST_KEY, fingerprints, identity_components
from bookloom.operators.batches import next_fit
from bookloom.operators.frontier import conversion_frontier as plan_frontier
from bookloom.operators.ranking import rank_in_groups
from bookloom.plans.portfolio import TOKEN_BYTES, decisions, selection_rows
from bookloom.plans.sql import contributor_steps, squeezed_sql
from bookloom.plans.works import format_rank
from bookloom.session import materialize
from bookloom.sources.tables import table

# Roles in a portfolio, from the least.
ROLES = ["redundant", "specialized", "supporting", "strong", "core", "essential"]
#: Works of a corpus that are converted, works of a batch.
CANDIDATES, BATCH = 360, 10
#: Characters of a summary that is shown.
SUMMARY = 240


def _catalog(spark: SparkSession, folder: str) -> DataFrame:
    """One row per work of the catalogue (the last classified), with the key of its leading creator."""
    best = F.coalesce(F.array_min(F.transform("sourceVariants", lambda v: format_rank(v["extension"]))), F.lit(99)).alias("format")
    rows = table(spark, folder, "catalog_works").where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classifiedAt", "author", "title", "canonicalKey", "canonicalWorkId", "priorityScore", "relevanceScore", best)).alias("r"))
    rows = rows.select("id", *[f"r.{c}" for c in ("author", "title", "canonicalKey", "canonicalWorkId", "priorityScore", "relevanceScore", "format")])
    first = F.coalesce(F.get(K.contributors(F.col("author")), F.lit(0)), F.lit(""))
    key = K.ascii_key(K.given_first(first))
    return rows.withColumn("creator", F.when(key != "", key).otherwise("unknown"))


def _identity(works: DataFrame) -> DataFrame:
    key = F.when(F.length(K.squeezed(F.col("canonicalKey"))) >= LEAST_KEY, F.lower(F.trim("canonicalKey")))
    return identity_components(works.withColumn("key", key))


def work_identity(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogued works that are one work, also through others: the smallest id of each."""
    return _identity(materialize(_catalog(spark, folder), "catalog"))


def _representatives(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    works = materialize(_catalog(spark, folder), "catalog")
    groups = materialize(_identity(works), "identity")
    d = materialize(decisions(spark, folder), "decisions")
    mentions = d.where("canonicalWorkId IS NOT NULL").groupBy(F.col("canonicalWorkId").alias("id")).agg(F.count(F.lit(1)).alias("mentions"))
    role = F.coalesce(*[F.when(F.col("portfolioRole") == r, k) for k, r in enumerate(ROLES, 1)], F.lit(0))
    rows = groups.join(d.select("id", role.alias("role"), "comparativePriority", "authorRank"), "id", "left").join(mentions, "id", "left").join(works.select("id", "format"), "id")
    order = F.struct(-F.coalesce("mentions", F.lit(0)), -F.coalesce("role", F.lit(0)), -F.coalesce("comparativePriority", F.lit(-1)), F.coalesce("authorRank", F.lit(999)), F.col("format"), F.col("id").alias("id"))
    best = rows.groupBy("component").agg(F.min(order)["id"].alias("representative"))
    return materialize(groups.join(best, "component").select("id", "representative"), "representatives"), d


def representatives(spark: SparkSession, folder: str) -> DataFrame:
    """The work that stands for each work and all that are the same: most often named, strongest role, priority, rank, format, id."""
    return _representatives(spark, folder)[0].withColumn("duplicate", F.col("id") != F.col("representative"))


def _relations(of: DataFrame, d: DataFrame) -> DataFrame:
    """(whole, part) between representatives, from both sides of each statement."""
    down = d.select(F.col("id").alias("whole"), F.explode("containsWorkIds").alias("part"))
    up = d.select(F.explode("containedByWorkIds").alias("whole"), F.col("id").alias("part"))
    edges = down.unionByName(up)
    for end in ("whole", "part"):
        edges = edges.join(of.select(F.col("id").alias(end), F.col("representative").alias("_r")), end, "left").withColumn(end, F.coalesce("_r", end)).drop("_r")
    return edges.where("whole != part").distinct()


def portfolio_entries(spark: SparkSession, folder: str) -> DataFrame:
    """For each representative what it contains and is contained in, duplicates' statements joined in, as sorted lists."""
    of, d = _representatives(spark, folder)
    edges = materialize(_relations(of, d), "relations")
    holds = edges.groupBy(F.col("whole").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("part")), ",").alias("contains"))
    held = edges.groupBy(F.col("part").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("whole")), ",").alias("containedBy"))
    own = of.where("id = representative").select("id")
    return own.join(holds, "id", "left").join(held, "id", "left").na.fill("", ["contains", "containedBy"])


def portfolio_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Works, duplicates, groups of duplicates, relations between representatives, contained and required works."""
    of, d = _representatives(spark, folder)
    edges = materialize(_relations(of, d), "relations").join(of.where("id = representative").select(F.col("id").alias("part")), "part", "left_semi")
    sizes = of.groupBy("representative").agg(F.count(F.lit(1)).alias("n"))
    required = d.where("mustInclude").join(of, "id").select("representative").distinct()
    counts = sizes.agg(F.sum("n").alias("works"), F.sum(F.col("n") - 1).alias("duplicates"), F.count_if(F.col("n") > 1).alias("duplicateGroups"))
    others = [edges.agg(F.count(F.lit(1)).alias("relations"), F.countDistinct("part").alias("contained")), required.agg(F.count(F.lit(1)).alias("required"))]
    for one in others:  # one row each
        counts = counts.join(F.broadcast(one))
    return counts


def creator_roster(spark: SparkSession, folder: str) -> DataFrame:
    """Each work's place among its creator's, by priority, relevance, title and id, and how many those are."""
    works = materialize(_catalog(spark, folder), "catalog").select("id", "creator", F.coalesce("priorityScore", F.lit(-1)).alias("p"), F.coalesce("relevanceScore", F.lit(-1)).alias("r"), F.coalesce("title", F.lit("")).alias("t"))
    placed = rank_in_groups(works, ["creator"], [F.col("p").desc(), F.col("r").desc(), F.col("t"), F.col("id")], out="place", total="works")
    return placed.select("id", "creator", "place", "works")


def curation_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Works in batches of ten: creators in the order of keys, each cut into chunks of ten, chunks put together while they fit."""
    placed = materialize(creator_roster(spark, folder).withColumn("chunk", F.ceil(F.col("place") / BATCH)), "roster")
    chunks = placed.groupBy("creator", "chunk").agg(F.count(F.lit(1)).alias("size"))
    batched = next_fit(chunks, [F.col("creator"), F.col("chunk")], "size", BATCH)
    return placed.join(batched, ["creator", "chunk"]).select("id", "creator", "chunk", "batch")


def decision_warnings(spark: SparkSession, folder: str) -> DataFrame:
    """References of decisions outside the roster of the work's creator and corpus, or to the work itself, by what is done about them."""
    d = materialize(decisions(spark, folder).select("id", "corpus", F.coalesce(F.lower(F.trim("creatorKey")), F.lit("unknown")).alias("creator"), "canonicalWorkId", "containsWorkIds", "containedByWorkIds"), "decisions")
    refs = d.where("canonicalWorkId IS NOT NULL").select("id", "corpus", "creator", F.lit("unknown_canonical_work").alias("code"), F.col("canonicalWorkId").alias("ref"))
    for column, code in (("containsWorkIds", "invalid_contains_relation"), ("containedByWorkIds", "invalid_contained_by_relation")):
        refs = refs.unionByName(d.select("id", "corpus", "creator", F.lit(code).alias("code"), F.explode(F.array_distinct(column)).alias("ref")))
    roster = d.select(F.col("id").alias("ref"), "corpus", "creator")
    outside = refs.join(roster, ["ref", "corpus", "creator"], "left_anti").unionByName(refs.where("ref = id AND code != 'unknown_canonical_work'").join(roster, ["ref", "corpus", "creator"], "left_semi").select("ref", "corpus", "creator", "id", "code"))
    return outside.select("id", "code", "ref", F.when(F.col("code") == "unknown_canonical_work", "replaced_with_self").otherwise("omitted").alias("action"))


def compact_works(spark: SparkSession, folder: str) -> DataFrame:
    """Works as a curator is shown them: a short summary, the creator's number of works, sources, and tokens guessed from the largest source."""
    v = F.col("sourceVariants")
    rows = table(spark, folder, "catalog_works").where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classifiedAt", "author", "title", "contentType", "summaryCz", F.coalesce(F.size(v), F.lit(0)).alias("sources"), F.array_max(F.transform(v, lambda x: x["size"])).alias("bytes"))).alias("r"))
    roster = creator_roster(spark, folder).select("id", F.col("works").alias("creatorWorks"))
    shown = F.substring(K.squeezed(F.col("r.summaryCz")), 1, SUMMARY)
    return rows.join(roster, "id").select("id", "r.contentType", shown.alias("summary"), "creatorWorks", F.greatest(F.col("r.sources"), F.lit(0)).alias("sources"), F.ceil(F.coalesce("r.bytes", F.lit(0)) / TOKEN_BYTES).alias("tokens"))


def catalog_order(spark: SparkSession, folder: str) -> DataFrame:
    """The place of each work in the catalogue: by target, priority, author, title and id."""
    rows = table(spark, folder, "catalog_works").where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classifiedAt", "author", "title", F.coalesce("target", F.lit("")).alias("target"), F.coalesce("priorityScore", F.lit(-1)).alias("p"))).alias("r"))
    keyed = rows.select("id", "r.target", "r.p", F.coalesce("r.author", F.lit("")).alias("a"), F.coalesce("r.title", F.lit("")).alias("t"))
    return rank_in_groups(keyed, [], [F.col("target"), F.col("p").desc(), F.col("a"), F.col("t"), F.col("id")], out="place").select("id", F.col("place").cast("bigint").alias("place"))


def work_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """A fingerprint of what curation sees of each work; a new one means the work must be looked at again."""
    fields = ["id", "title", "contentType", "relevanceScore", "priorityScore"]
    rows = table(spark, folder, "catalog_works").where("id IS NOT NULL").groupBy("id").agg(F.max(F.struct("classifiedAt", "author", *fields[1:])).alias("r"))
    return fingerprints(rows.select("id", *[F.col(f"r.{c}").alias(c) for c in fields[1:]]), "id", fields)


def conversion_frontier(spark: SparkSession, folder: str) -> DataFrame:
    """Which works of each corpus are converted, and why; known are those that an earlier run decided on."""
    d = materialize(selection_rows(spark, folder, standalone=True), "frontier")
    paths = closure.closure(closure.relations(decisions(spark, folder)))
    runs = table(spark, folder, "curated_works").select("id", "runId")
    earlier = runs.join(F.broadcast(runs.agg(F.max("runId").alias("last")))).where("runId < last").select("id").distinct()
    return plan_frontier(d, paths, CANDIDATES, known=earlier)


QUERIES = {f.__name__: f for f in (work_identity, representatives, portfolio_entries, portfolio_summary, creator_roster, curation_batches, decision_warnings, compact_works, catalog_order, work_fingerprints, conversion_frontier)}

_squeezed = squeezed_sql


_CATALOG = f"""c0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY classifiedAt DESC NULLS LAST, author DESC NULLS LAST, title DESC NULLS LAST) AS k FROM catalog_works WHERE id IS NOT NULL) WHERE k = 1),
{contributor_steps('c', 'c0')},
c AS (SELECT id, author, title, canonicalKey, canonicalWorkId, priorityScore, relevanceScore, coalesce(list_min(list_transform(sourceVariants, lambda v: CASE lower(v.extension) WHEN '.md' THEN 0 WHEN '.epub' THEN 1 WHEN '.pdf' THEN 2 ELSE 3 END)), 99) AS format, coalesce(nullif(nameKeys[1], ''), 'unknown') AS creator FROM c3)"""
_IDENTITY = f"""{_CATALOG}, t AS (SELECT a.id AS x, b.id AS y FROM c a JOIN c b ON a.canonicalWorkId = b.id AND a.creator = b.creator
    UNION SELECT a.id, b.id FROM c a JOIN c b ON a.creator = b.creator AND lower(trim(a.canonicalKey)) = lower(trim(b.canonicalKey)) WHERE length({_squeezed('a.canonicalKey')}) >= 3 AND length({_squeezed('b.canonicalKey')}) >= 3),
s AS (SELECT x, y FROM t UNION SELECT y, x FROM t), r AS (SELECT x, y FROM s UNION SELECT r.x, s.y FROM r JOIN s ON r.y = s.x), g AS (SELECT c.id, least(c.id, coalesce(min(y), c.id)) AS component FROM c LEFT JOIN r ON x = c.id GROUP BY c.id)"""
_D = "d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY runId DESC, decidedAt DESC, loadedAt DESC) AS k FROM curated_works) WHERE k = 1)"
_REPRESENTED = f"""{_IDENTITY}, {_D}, n AS (SELECT canonicalWorkId AS id, count(*) AS mentions FROM d WHERE canonicalWorkId IS NOT NULL GROUP BY 1),
o AS (SELECT g.id, component, row_number() OVER (PARTITION BY component ORDER BY coalesce(mentions, 0) DESC, CASE portfolioRole WHEN 'essential' THEN 6 WHEN 'core' THEN 5 WHEN 'strong' THEN 4 WHEN 'supporting' THEN 3 WHEN 'specialized' THEN 2 WHEN 'redundant' THEN 1 ELSE 0 END DESC,
    coalesce(comparativePriority, -1) DESC, coalesce(authorRank, 999), format, g.id) AS place FROM g LEFT JOIN d ON d.id = g.id LEFT JOIN n ON n.id = g.id JOIN c ON c.id = g.id),
rep AS (SELECT o.id, b.id AS representative FROM o JOIN o b ON b.component = o.component AND b.place = 1)"""
_EDGES = f"""{_REPRESENTED}, e0 AS (SELECT id AS whole, unnest(containsWorkIds) AS part FROM d UNION SELECT unnest(containedByWorkIds), id FROM d),
e AS (SELECT DISTINCT coalesce(w.representative, whole) AS whole, coalesce(p.representative, part) AS part FROM e0 LEFT JOIN rep w ON w.id = whole LEFT JOIN rep p ON p.id = part WHERE coalesce(w.representative, whole) <> coalesce(p.representative, part))"""
_ROSTER = f"{_CATALOG}, p AS (SELECT id, creator, row_number() OVER (PARTITION BY creator ORDER BY coalesce(priorityScore, -1) DESC, coalesce(relevanceScore, -1) DESC, coalesce(title, ''), id) AS place, count(*) OVER (PARTITION BY creator) AS works FROM c)"
SQL = {
    "work_identity": f"WITH RECURSIVE {_IDENTITY} SELECT id, component FROM g",
    "representatives": f"WITH RECURSIVE {_REPRESENTED} SELECT id, representative, id <> representative AS duplicate FROM rep",
    "portfolio_entries": f"""WITH RECURSIVE {_EDGES} SELECT id, coalesce((SELECT string_agg(part, ',' ORDER BY part) FROM e WHERE whole = rep.id), '') AS contains, coalesce((SELECT string_agg(whole, ',' ORDER BY whole) FROM e WHERE part = rep.id), '') AS containedBy FROM rep WHERE id = representative""",
    "portfolio_summary": f"""WITH RECURSIVE {_EDGES}, z AS (SELECT representative, count(*) AS n FROM rep GROUP BY 1), k AS (SELECT * FROM e WHERE part IN (SELECT id FROM rep WHERE id = representative))
SELECT sum(n) AS works, sum(n - 1) AS duplicates, count_if(n > 1) AS duplicateGroups, (SELECT count(*) FROM k) AS relations, (SELECT count(DISTINCT part) FROM k) AS contained, (SELECT count(DISTINCT representative) FROM d JOIN rep USING (id) WHERE mustInclude) AS required FROM z""",
    "creator_roster": f"WITH {_ROSTER} SELECT id, creator, place, works FROM p",
    "curation_batches": f"""WITH RECURSIVE {_ROSTER}, q AS (SELECT *, CAST(ceil(place / 10.0) AS BIGINT) AS chunk FROM p), h AS (SELECT creator, chunk, count(*) AS size, row_number() OVER (ORDER BY creator, chunk) AS i FROM q GROUP BY 1, 2),
b AS (SELECT 1::BIGINT AS i, 1::BIGINT AS batch, size AS held FROM h WHERE i = 1 UNION ALL
    SELECT h.i, b.batch + CASE WHEN b.held >= 10 OR b.held + h.size > 10 THEN 1 ELSE 0 END, CASE WHEN b.held >= 10 OR b.held + h.size > 10 THEN h.size ELSE b.held + h.size END FROM b JOIN h ON h.i = b.i + 1)
SELECT id, creator, chunk, batch FROM q JOIN h USING (creator, chunk) JOIN b USING (i)""",
    "compact_works": f"""WITH {_ROSTER} SELECT c0.id, contentType, substr({squeezed_sql('summaryCz')}, 1, 240) AS summary, works AS creatorWorks, coalesce(len(sourceVariants), 0) AS sources, CAST(ceil(coalesce(list_max(list_transform(sourceVariants, lambda v: v.size)), 0) / 4.0) AS BIGINT) AS tokens FROM c0 JOIN p USING (id)""",
    "catalog_order": "SELECT id, row_number() OVER (ORDER BY coalesce(target, ''), coalesce(priorityScore, -1) DESC, coalesce(author, ''), coalesce(title, ''), id) AS place FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY classifiedAt DESC NULLS LAST, author DESC NULLS LAST, title DESC NULLS LAST) AS k FROM catalog_works WHERE id IS NOT NULL) WHERE k = 1",
    "work_fingerprints": "SELECT id, sha256(CAST(to_json({'id': id, 'title': title, 'contentType': contentType, 'relevanceScore': relevanceScore, 'priorityScore': priorityScore}) AS VARCHAR)) AS fingerprint FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY classifiedAt DESC NULLS LAST, author DESC NULLS LAST, title DESC NULLS LAST) AS k FROM catalog_works WHERE id IS NOT NULL) WHERE k = 1",
    "decision_warnings": f"""WITH {_D}, k AS (SELECT *, coalesce(lower(trim(creatorKey)), 'unknown') AS creator FROM d),
r AS (SELECT id, corpus, creator, 'unknown_canonical_work' AS code, canonicalWorkId AS ref FROM k WHERE canonicalWorkId IS NOT NULL UNION SELECT id, corpus, creator, 'invalid_contains_relation', unnest(containsWorkIds) FROM k UNION SELECT id, corpus, creator, 'invalid_contained_by_relation', unnest(containedByWorkIds) FROM k)
SELECT r.id, code, ref, CASE WHEN code = 'unknown_canonical_work' THEN 'replaced_with_self' ELSE 'omitted' END AS action FROM r WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.id = ref AND k.corpus = r.corpus AND k.creator = r.creator) OR (ref = r.id AND code <> 'unknown_canonical_work')""",
}
