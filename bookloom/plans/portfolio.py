"""Queries over curation decisions: identity, containment, scores, choice, files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookloom.functions import scoring as S
from bookloom.operators import buckets, closure
from bookloom.operators.graph import components
from bookloom.operators.select import select_portfolio
from bookloom.operators.skew import split_join
from bookloom.session import materialize
from bookloom.sources.tables import table

#: Budget of one file: bytes and tokens; files of a corpus; bytes of a token before conversion.
FILE_BYTES, FILE_TOKENS, FILES, TOKEN_BYTES = 11_010_048, 1_700_000, 18, 4
#: Priority of a work without one.
PRIORITY = 50

_KEEP = ["title", "author", "corpus", "relevanceScore", "priorityScore", "comparativePriority", "portfolioRole", "authorRank", "creatorKey", "creatorWorkCount", "bundleLikeOrigin", "canonicalWorkId", "containsWorkIds", "containedByWorkIds", "topicKeys", "standaloneValue", "mustInclude", "authorSoftMaximum", "selectionSizeTokens"]


def decisions(spark: SparkSession, folder: str) -> DataFrame:
    """The latest decision of the latest run on each work."""
    rows = table(spark, folder, "curated_works").where("id IS NOT NULL")
    newest = F.max(F.struct("runId", "decidedAt", "loadedAt", *_KEEP)).alias("r")
    return rows.groupBy("id").agg(newest).select("id", *[F.col(f"r.{c}").alias(c) for c in _KEEP])


def identity_components(spark: SparkSession, folder: str) -> DataFrame:
    """Works that are one work: the one names the other as canonical, and both have one creator."""
    d = decisions(spark, folder).select("id", "canonicalWorkId", F.lower(F.trim("creatorKey")).alias("creator"))
    other = d.select(F.col("id").alias("canonicalWorkId"), F.col("creator").alias("theirs"))
    edges = d.join(other, "canonicalWorkId").where("creator = theirs AND id != canonicalWorkId").select(F.col("id").alias("a"), F.col("canonicalWorkId").alias("b"))
    return components(edges).select(F.col("node").alias("id"), "component")


def damage(spark: SparkSession, folder: str) -> DataFrame:
    """(id, damage): wrongly decoded signs for every thousand words, the worst of a work's units as last loaded."""
    u = table(spark, folder, "book_units").where("workId IS NOT NULL").select("workId", "unitIndex", "loadedAt", F.coalesce("quality.mojibakePerThousandWords", F.lit(0.0)).alias("d"))
    last = u.groupBy("workId", "unitIndex").agg(F.max(F.struct("loadedAt", "d")).alias("r"))
    return last.groupBy(F.col("workId").alias("id")).agg(F.max("r.d").alias("damage"))


def duplicate_survivor(spark: SparkSession, folder: str) -> DataFrame:
    """Of works with one canonical id the one that stays: must-include, role, priority, least damage, relevance, size, title."""
    d = decisions(spark, folder).withColumn("key", F.coalesce("canonicalWorkId", "id")).join(damage(spark, folder), "id", "left")
    order = F.struct(-F.col("mustInclude").cast("int"), -S.role_weight(F.col("portfolioRole")), -F.col("comparativePriority"), F.coalesce("damage", F.lit(0.0)), -F.col("relevanceScore"), F.col("selectionSizeTokens"), F.col("title"), F.col("id").alias("id"))
    best = d.groupBy("key").agg(F.min(order)["id"].alias("survivor"))
    return d.join(best, "key").select("id", F.when(F.col("id") == F.col("survivor"), "kept").otherwise(F.concat(F.lit("exact_duplicate:"), "survivor")).alias("outcome"))


def containment_closure(spark: SparkSession, folder: str) -> DataFrame:
    """Every work and what it contains, directly or through others."""
    return closure.closure(closure.relations(decisions(spark, folder)))


def topic_inheritance(spark: SparkSession, folder: str) -> DataFrame:
    """Works with their own topics and those of what they contain, counted."""
    d = decisions(spark, folder)
    topics = closure.inherited_topics(d, closure.closure(closure.relations(d)))
    return topics.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("topic")), ",").alias("topics"), F.count(F.lit(1)).alias("n"))


def _prepared(spark: SparkSession, folder: str) -> DataFrame:
    d = materialize(decisions(spark, folder), "decisions")
    paths = closure.closure(closure.relations(d))
    above = paths.join(d.select(F.col("id").alias("whole"), F.col("comparativePriority").alias("p")), "whole").groupBy(F.col("part").alias("id")).agg(F.max("p").alias("abovePriority"))
    below = paths.groupBy(F.col("whole").alias("id")).agg(F.collect_set("part").alias("parts"))
    d = d.join(above, "id", "left").join(below, "id", "left")
    lifted = F.col("abovePriority").isNotNull() & (F.col("standaloneValue") == "high")
    penalty = F.least(F.lit(36), F.greatest(F.lit(0), (F.coalesce("authorRank", F.lit(1)) - 1) * 3))
    priority = F.when(lifted, F.greatest(F.col("comparativePriority"), F.col("abovePriority") - penalty)).otherwise(F.col("comparativePriority"))
    strong = lifted & (S.role_weight(F.col("portfolioRole")) < S.ROLES["strong"])
    d = d.withColumn("priority", F.greatest(F.lit(0), F.least(F.lit(100), priority))).withColumn("role", F.when(strong, "strong").otherwise(F.col("portfolioRole")))
    utility = S.static_utility(F.col("priority"), F.col("role"), F.col("relevanceScore"), F.col("mustInclude"), F.col("creatorWorkCount"), F.col("authorRank"), F.col("selectionSizeTokens"), F.col("parts").isNotNull(), F.col("abovePriority").isNotNull(), F.col("standaloneValue"))
    return d.withColumn("static", utility)


def effective_priority(spark: SparkSession, folder: str) -> DataFrame:
    """Priority and role after parts have been lifted by what contains them."""
    return _prepared(spark, folder).select("id", "priority", "role")


def candidate_ranking(spark: SparkSession, folder: str) -> DataFrame:
    """The static utility of every work."""
    return _prepared(spark, folder).select("id", F.round("static", 6).alias("utility"))


def selection_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Works and tokens per corpus and topic, with totals."""
    d = decisions(spark, folder).select("corpus", "selectionSizeTokens", F.explode("topicKeys").alias("topic"))
    return d.rollup("corpus", "topic").agg(F.count(F.lit(1)).alias("works"), F.sum("selectionSizeTokens").alias("tokens")).select(F.coalesce("corpus", F.lit("all")).alias("corpus"), F.coalesce("topic", F.lit("all")).alias("topic"), "works", "tokens")


def overlap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of works with content in common: one contains the other, or both contain a third."""
    d = decisions(spark, folder)
    held = closure.closure(closure.relations(d)).select(F.col("whole").alias("id"), F.col("part").alias("content"))
    own = held.select("id").unionByName(held.select(F.col("content").alias("id"))).distinct().withColumn("content", F.col("id"))
    all_held = held.unionByName(own)
    all_held = materialize(all_held, "held")
    x, y = (all_held.select("content", F.col("id").alias(f"id_{s}")) for s in "ab")
    return split_join(x, y, ["content"]).where("id_a < id_b").groupBy("id_a", "id_b").agg(F.count(F.lit(1)).alias("shared"))


def reference_repair(spark: SparkSession, folder: str) -> DataFrame:
    """References of decisions to works no decision is about, which are dropped."""
    d = decisions(spark, folder)
    refs = d.select("id", F.lit("contains").alias("field"), F.explode("containsWorkIds").alias("ref")).unionByName(d.select("id", F.lit("containedBy").alias("field"), F.explode("containedByWorkIds").alias("ref")))
    refs = refs.unionByName(d.where("canonicalWorkId IS NOT NULL").select("id", F.lit("canonical").alias("field"), F.col("canonicalWorkId").alias("ref"))).distinct()
    return refs.join(d.select(F.col("id").alias("ref")), "ref", "left_anti").select("id", "field", "ref")


def run_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Works added, dropped and kept from each run to the next, and whether the next only appends."""
    runs = table(spark, folder, "curated_works").select("runId", "id").distinct()
    order = runs.select("runId").distinct().select("runId", F.concat(F.lit("run_"), F.lpad((F.regexp_extract("runId", r"(\d+)", 1).cast("int") + 1).cast("string"), 4, "0")).alias("next"))
    old = runs.join(order, "runId").select(F.col("next").alias("runId"), "id").withColumn("before", F.lit(1))
    both = runs.withColumn("now", F.lit(1)).join(old, ["runId", "id"], "full_outer").join(runs.select("runId").distinct(), "runId", "left_semi")
    out = both.groupBy("runId").agg(F.count_if(F.col("before").isNull()).alias("added"), F.count_if(F.col("now").isNull()).alias("dropped"), F.count_if(F.col("now").isNotNull() & F.col("before").isNotNull()).alias("kept"))
    return out.withColumn("onlyAppends", F.col("dropped") == 0)


def selection_rows(spark: SparkSession, folder: str, standalone: bool = False) -> DataFrame:
    """Works as :func:`select_portfolio` takes them, with the worth of each alone if asked for."""
    d = _prepared(spark, folder).join(damage(spark, folder), "id", "left")
    return d.select(
        "corpus", "id", F.coalesce("title", F.lit("")).alias("title"), F.coalesce("creatorKey", F.lit("unknown")).alias("creator"), "static", "priority", S.role_weight(F.col("role")).alias("role"), F.col("relevanceScore").alias("relevance"), F.col("mustInclude").alias("must"),
        F.coalesce("damage", F.lit(0.0)).alias("damage"), (F.col("selectionSizeTokens") * TOKEN_BYTES).alias("bytes"), F.col("selectionSizeTokens").alias("tokens"), F.col("authorSoftMaximum").cast("double").alias("cap"), F.col("bundleLikeOrigin").alias("bundle"),
        F.coalesce("topicKeys", F.array().cast("array<string>")).alias("topics"), F.array_union(F.array("id"), F.coalesce("parts", F.array().cast("array<string>"))).alias("content"),
        *([F.col("standaloneValue").alias("standalone")] if standalone else []),
    )


def portfolio_select(spark: SparkSession, folder: str) -> DataFrame:
    """The portfolio of each corpus under the budget of its files, and why each other work is not in it."""
    return select_portfolio(selection_rows(spark, folder), FILES * FILE_BYTES, FILES * FILE_TOKENS)


def file_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Book units of each corpus packed into its files; where those do not hold all, works go by their score in the portfolio, then priority; 0 and ``PRIORITY`` without a decision."""
    u = table(spark, folder, "book_units").where("workId IS NOT NULL AND content IS NOT NULL")
    one = u.groupBy(F.col("workId").alias("id"), "unitIndex").agg(F.max(F.struct("loadedAt", "corpus", "title", "content")).alias("r"))
    size = F.octet_length("r.content")
    priority = decisions(spark, folder).select("id", F.coalesce("comparativePriority", "priorityScore").alias("priority"))
    valued = one.join(portfolio_select(spark, folder).select("id", "score"), "id", "left").join(priority, "id", "left")
    rows = valued.select(F.coalesce("r.corpus", F.lit("null")).alias("corpus"), "id", F.col("unitIndex").cast("bigint").alias("unit"), F.coalesce("r.title", F.lit("")).alias("title"), F.coalesce("score", F.lit(0.0)).alias("score"), F.coalesce("priority", F.lit(PRIORITY)).alias("priority"), size.alias("bytes"), F.ceil(size / TOKEN_BYTES).alias("tokens"))
    return buckets.pack_files(rows, FILE_BYTES, FILE_TOKENS, FILES)


def creator_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Decisions of each creator in chunks of ten, by id."""
    from bookloom.operators.ranking import rank_in_groups

    d = decisions(spark, folder).select("id", F.coalesce(F.lower(F.trim("creatorKey")), F.lit("unknown")).alias("creator"))
    placed = rank_in_groups(d, ["creator"], [F.col("id")], out="place", total="works")
    return placed.select("id", "creator", F.ceil(F.col("place") / 10).alias("chunk"), F.ceil(F.col("works") / 10).alias("chunks"))


QUERIES = {f.__name__: f for f in (identity_components, duplicate_survivor, containment_closure, topic_inheritance, effective_priority, candidate_ranking, selection_summary, overlap_pairs, reference_repair, run_changes, portfolio_select, file_packing, creator_batches)}

_D = "d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY runId DESC, decidedAt DESC, loadedAt DESC) AS k FROM curated_works) WHERE k = 1)"
_PATHS = f"""RECURSIVE {_D}, e AS (SELECT e.* FROM (SELECT id AS whole, unnest(containsWorkIds) AS part FROM d UNION SELECT unnest(containedByWorkIds), id FROM d) e WHERE whole <> part AND whole IN (SELECT id FROM d) AND part IN (SELECT id FROM d)),
p AS (SELECT whole, part FROM e UNION SELECT p.whole, e.part FROM p JOIN e ON p.part = e.whole)"""
_ROLE = "CASE {0} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in S.ROLES.items()) + " ELSE 0 END"
_EFFECTIVE = f"""{_PATHS}, above AS (SELECT part AS id, max(comparativePriority) AS ap FROM p JOIN d ON d.id = p.whole GROUP BY part), w AS (SELECT d.*, ap, ap IS NOT NULL AND standaloneValue = 'high' AS lifted, d.id IN (SELECT whole FROM p) AS holds FROM d LEFT JOIN above USING (id)),
x AS (SELECT *, greatest(0, least(100, CASE WHEN lifted THEN greatest(comparativePriority, ap - least(36, greatest(0, (coalesce(authorRank, 1) - 1) * 3))) ELSE comparativePriority END)) AS priority, CASE WHEN lifted AND {_ROLE.format('portfolioRole')} < 16 THEN 'strong' ELSE portfolioRole END AS role FROM w)"""
_DOUBLE = "greatest(0.0, log2(greatest(selectionSizeTokens, 1) / 250000.0))"
SQL = {
    "identity_components": f"""WITH RECURSIVE {_D}, k AS (SELECT id, canonicalWorkId, lower(trim(creatorKey)) AS c FROM d), t AS (SELECT a.id AS x, b.id AS y FROM k a JOIN k b ON a.canonicalWorkId = b.id AND a.c = b.c AND a.id <> b.id), s AS (SELECT x, y FROM t UNION SELECT y, x FROM t),
r AS (SELECT x, y FROM s UNION SELECT r.x, s.y FROM r JOIN s ON r.y = s.x) SELECT x AS id, least(x, min(y)) AS component FROM r GROUP BY x""",
    "duplicate_survivor": f"""WITH {_D}, u AS (SELECT workId, coalesce(quality.mojibakePerThousandWords, 0) AS g, row_number() OVER (PARTITION BY workId, unitIndex ORDER BY loadedAt DESC, quality.mojibakePerThousandWords DESC NULLS LAST) AS k FROM book_units),
m AS (SELECT workId, max(g) AS damage FROM u WHERE k = 1 GROUP BY workId), s AS (SELECT d.id, first_value(d.id) OVER (PARTITION BY coalesce(canonicalWorkId, d.id) ORDER BY mustInclude DESC, {_ROLE.format('portfolioRole')} DESC, comparativePriority DESC, coalesce(damage, 0), relevanceScore DESC, selectionSizeTokens, title, d.id) AS survivor FROM d LEFT JOIN m ON m.workId = d.id)
SELECT id, CASE WHEN id = survivor THEN 'kept' ELSE 'exact_duplicate:' || survivor END AS outcome FROM s""",
    "containment_closure": f"WITH {_PATHS} SELECT whole, part FROM p",
    "topic_inheritance": f"WITH {_PATHS}, o AS (SELECT id, unnest(topicKeys) AS topic FROM d), a AS (SELECT id, topic FROM o UNION SELECT p.whole, o.topic FROM p JOIN o ON o.id = p.part) SELECT id, string_agg(topic, ',' ORDER BY topic) AS topics, count(*) AS n FROM a GROUP BY id",
    "effective_priority": f"WITH {_EFFECTIVE} SELECT id, priority, role FROM x",
    "candidate_ranking": f"""WITH {_EFFECTIVE} SELECT id, round(priority + {_ROLE.format('role')} + greatest(0, relevanceScore - 70) * 0.18::DOUBLE + CASE WHEN mustInclude THEN 100 ELSE 0 END + 25 / sqrt(greatest(1, creatorWorkCount)) - least(24, greatest(0, authorRank - 1) * 0.55::DOUBLE)
    - 6 * {_DOUBLE} - CASE WHEN holds THEN 14 * {_DOUBLE} ELSE 0 END + CASE WHEN ap IS NULL THEN 0 WHEN standaloneValue = 'high' THEN 6 WHEN standaloneValue = 'low' THEN -10 ELSE 0 END, 6) AS utility FROM x""",
    "selection_summary": f"WITH {_D} SELECT coalesce(corpus, 'all') AS corpus, coalesce(topic, 'all') AS topic, count(*) AS works, sum(selectionSizeTokens) AS tokens FROM (SELECT corpus, selectionSizeTokens, unnest(topicKeys) AS topic FROM d) GROUP BY ROLLUP (corpus, topic)",
    "overlap_pairs": f"WITH {_PATHS}, h AS (SELECT whole AS id, part AS content FROM p UNION SELECT whole, whole FROM p UNION SELECT part, part FROM p) SELECT a.id AS id_a, b.id AS id_b, count(*) AS shared FROM h a JOIN h b ON a.content = b.content AND a.id < b.id GROUP BY 1, 2",
    "reference_repair": f"""WITH {_D}, r AS (SELECT id, 'contains' AS field, unnest(containsWorkIds) AS ref FROM d UNION SELECT id, 'containedBy', unnest(containedByWorkIds) FROM d UNION SELECT id, 'canonical', canonicalWorkId FROM d WHERE canonicalWorkId IS NOT NULL) SELECT id, field, ref FROM r WHERE ref NOT IN (SELECT id FROM d)""",
    "run_changes": """WITH r AS (SELECT DISTINCT runId, id FROM curated_works), o AS (SELECT printf('run_%04d', CAST(regexp_extract(runId, '(\\d+)', 1) AS INT) + 1) AS runId, id FROM r),
b AS (SELECT coalesce(r.runId, o.runId) AS runId, r.id IS NOT NULL AS now, o.id IS NOT NULL AS before FROM r FULL JOIN o ON r.runId = o.runId AND r.id = o.id)
SELECT runId, count_if(NOT before) AS added, count_if(NOT now) AS dropped, count_if(now AND before) AS kept, count_if(NOT now) = 0 AS onlyAppends FROM b WHERE runId IN (SELECT runId FROM r) GROUP BY runId""",
    "creator_batches": f"""WITH {_D}, k AS (SELECT id, coalesce(lower(trim(creatorKey)), 'unknown') AS creator FROM d) SELECT id, creator, CAST(ceil(row_number() OVER (PARTITION BY creator ORDER BY id) / 10.0) AS BIGINT) AS chunk, CAST(ceil(count(*) OVER (PARTITION BY creator) / 10.0) AS BIGINT) AS chunks FROM k""",
}
