"""Best representative of each duplicate group, by consistent bundles.

Works are tied through shared keys and named ids (:func:`tie_works`).  Fields
that depend on one another form a bundle, and a survivor takes a bundle whole
from one record (:func:`golden_records`).  Functional dependencies tie bundles
to one another: an edition key determines the title, a canonical work determines
the edition key and the title, a title determines the language of the
description, and so does the language of the sources.  A dependency holds
between two chosen bundles where some record of the group holds both values, or
one of them is empty.  :func:`choose_bundles` searches the choice of greatest
trust by branch and bound.
"""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.operators.graph import clean_key, components, star_edges
from bookloom.session import materialize

# Texts that stand for a missing value.
PLACEHOLDERS = ["-", "--", "–", "—", "?", "n/a", "na", "n.a.", "none", "null", "nan", "unknown", "neznámý", "neznámá", "neznámé", "unbekannt", "inconnu", "tbd"]

#: Fields that are taken together from one record.
BUNDLES = {
    "identity": ["canonicalKey", "author", "title"],
    "edition": ["editionGroupKey", "editionNote"],
    "canonical": ["canonicalWorkId"],
    "description": ["language", "summaryCz"],
    "sources": ["sourceVariants"],
    "judgement": ["contentType", "target", "relevanceScore", "priorityScore", "confidence", "reasonCz", "evidence"],
}

#: Bundles tied by a functional dependency, and the one the search branches on.
TIES = [("identity", "edition"), ("identity", "canonical"), ("edition", "canonical"), ("identity", "description"), ("description", "sources")]
ROOT = "identity"

#: The fields whose presence makes a record complete.
COMPLETE = ["author", "title", "language", "summaryCz", "editionNote", "reasonCz"]


#: Stands for no time: earlier than any, and exact as a double.
NEVER = -(2**50)


def filled(name: str) -> Column:
    """Whether a text field holds something other than blank or a placeholder."""
    text = clean_key(F.col(name))
    return text.isNotNull() & ~text.isin(PLACEHOLDERS)


def confidence_rank(column: Column) -> Column:
    """high 3, medium 2, low 1, anything else 0."""
    text = clean_key(column)
    return F.when(text == "high", 3).when(text == "medium", 2).when(text == "low", 1).otherwise(0)


def record_marks(catalog: DataFrame) -> DataFrame:
    """(id, filledCount, at, confidenceRank): the three marks a survivor is chosen by.

    Of several rows with one id the most complete counts, then the latest, then
    the most confident.  Null ids are dropped; a null ``classifiedAt`` is
    earlier than any time.
    """
    count = sum((F.when(filled(c), 1).otherwise(0) for c in COMPLETE), F.when(F.size("sourceVariants") > 0, 1).otherwise(0))
    marks = F.struct(count.alias("f"), F.coalesce(F.unix_micros("classifiedAt"), F.lit(NEVER)).alias("t"), confidence_rank(F.col("confidence")).alias("c"))
    best = catalog.where("id IS NOT NULL").groupBy("id").agg(F.max(marks).alias("m"))
    return best.select("id", F.col("m.f").alias("filledCount"), F.col("m.t").alias("at"), F.col("m.c").alias("confidenceRank"))


def tie_works(catalog: DataFrame) -> DataFrame:
    """(id, group_id): works tied to at least one other; group_id is the group's smallest id.

    Ties: ``canonicalWorkId`` names another work's id (ids that lead nowhere tie
    nothing); ``editionGroupKey`` is equal after trimming and lower-casing
    (null, blank and placeholders tie nothing); two ``sourceVariants`` of size
    above 0 have one ``sha256``.  Null or empty arrays tie nothing, repeated
    rows change nothing, an empty table gives no row.
    """
    works = catalog.where("id IS NOT NULL")
    edition = F.lower(F.regexp_replace("editionGroupKey", r"(?U)^\s+|\s+$", ""))
    by_edition = works.where(filled("editionGroupKey")).select(F.col("id").alias("node"), F.concat(F.lit("e:"), edition).alias("key"))
    variants = works.select("id", F.explode("sourceVariants").alias("v")).where("v.size > 0 AND v.sha256 IS NOT NULL AND trim(v.sha256) != ''")
    by_bytes = variants.select(F.col("id").alias("node"), F.concat(F.lit("s:"), F.col("v.sha256")).alias("key"))
    named = works.where("canonicalWorkId IS NOT NULL AND canonicalWorkId != id").select(F.col("id").alias("a"), F.col("canonicalWorkId").alias("b")).distinct()
    ids = works.select(F.col("id").alias("b")).distinct()
    edges = star_edges(by_edition.unionByName(by_bytes)).unionByName(named.join(ids, "b", "left_semi").select("a", "b"))
    return components(edges).select(F.col("node").alias("id"), F.col("component").alias("group_id"))


def survivors(catalog: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(group_id, survivor_id): the record that a group's built record is named after.

    It is the most complete record, then the latest, the most confident, the
    smallest id.
    """
    marks = record_marks(catalog).join(groups if groups is not None else tie_works(catalog), "id")
    # smallest id among equals: min of a struct whose numbers are negated
    order = F.struct((-F.col("filledCount")).alias("f"), (-F.col("at")).alias("t"), (-F.col("confidenceRank")).alias("c"), F.col("id").alias("id"))
    return marks.groupBy("group_id").agg(F.min(order)["id"].alias("survivor_id"))


def undisputed(catalog: DataFrame) -> DataFrame:
    """(group_id, survivor_id): groups in which one record alone is best in every mark.

    Each mark is a bundle whose trust is its value, and the record's id
    determines all three, so a consistent choice takes all marks from one
    record.  The search's bound, the sum of the best marks, is reached by the
    records that are best in all of them.
    """
    marks = materialize(record_marks(catalog).join(tie_works(catalog), "id"), "marks")
    names = {"filled": "filledCount", "recent": "at", "sure": "confidenceRank"}
    records = marks.select("group_id", "id", *[F.col("id").alias(f"{b}_sig") for b in names], *[F.col(c).cast("double").alias(f"{b}_trust") for b, c in names.items()])
    best = choose_bundles(records, list(names), [("filled", "recent"), ("filled", "sure")], "filled")
    return best.where("total = bound AND ways = 1").select("group_id", F.col("taken")[0]["id"].alias("survivor_id"))


def _signature(column: Column) -> Column:
    return F.coalesce(F.regexp_replace(clean_key(column), r"[^\p{L}\p{N}]+", " "), F.lit(""))


def _language(column: Column) -> Column:
    """First two letters of a language, with its English and own names mapped to them."""
    text = clean_key(column)
    known = {"english": "en", "čeština": "cs", "czech": "cs", "deutsch": "de", "german": "de", "français": "fr", "french": "fr"}
    named = F.coalesce(*[F.when(text == k, v) for k, v in known.items()], F.substring(text, 1, 2))
    return named


def _sources_language(variants: Column) -> Column:
    """The language that most source variants state, the first by name among equals; empty where none does."""
    said = F.filter(F.transform(variants, lambda v: _language(v["classificationLanguage"])), lambda x: x.isNotNull())
    counted = F.transform(F.array_distinct(said), lambda x: F.struct((-F.size(F.filter(said, lambda y: y == x))).alias("n"), x.alias("x")))
    return F.coalesce(F.array_min(counted)["x"], F.lit(""))


def bundle_records(catalog: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, id, and of each bundle its ``_sig`` and ``_trust``): what each record offers.

    Trust is 100 for each filled field of the bundle, 10 for each step of
    confidence, and below 10 for recency.  ``_sig`` is the value that
    dependencies look at, empty where it is not filled.
    """
    rows = catalog.join(groups, "id")
    span = catalog.agg(F.min("classifiedAt").alias("lo"), F.max("classifiedAt").alias("hi"))
    recency = F.coalesce((F.unix_micros("classifiedAt") - F.unix_micros("lo")) / F.greatest(F.unix_micros("hi") - F.unix_micros("lo"), F.lit(1)), F.lit(0.0)) * 9
    types = dict(catalog.dtypes)

    def has(c: str) -> Column:
        if c == "sourceVariants":
            return F.coalesce(F.size(c) > 0, F.lit(False))
        return F.coalesce(filled(c), F.lit(False)) if types[c] == "string" else F.col(c).isNotNull()

    of = {"identity": ("title", _signature(F.col("title"))), "edition": ("editionGroupKey", clean_key(F.col("editionGroupKey"))), "canonical": ("canonicalWorkId", clean_key(F.col("canonicalWorkId"))), "description": ("language", _language(F.col("language"))), "sources": ("sourceVariants", _sources_language(F.col("sourceVariants")))}
    rows = rows.join(F.broadcast(span)).withColumn("_marks", confidence_rank(F.col("confidence")) * 10 + recency)
    sigs = [(F.coalesce(F.when(has(of[b][0]), of[b][1]), F.lit("")) if b in of else F.lit("")).alias(f"{b}_sig") for b in BUNDLES]
    trusts = [reduce(lambda x, y: x + y, (F.when(has(c), 100.0).otherwise(0.0) for c in f), F.col("_marks")).alias(f"{b}_trust") for b, f in BUNDLES.items()]
    return rows.select("group_id", "id", *sigs, *trusts)


#: Sums of trust that differ by less are equal.
EPSILON = 1e-6


def _pairs(records: DataFrame, x: str, y: str) -> DataFrame:
    """(group_id, x, y): values of two bundles that a record of the group holds together."""
    return records.where((F.col(f"{x}_sig") != "") & (F.col(f"{y}_sig") != "")).select("group_id", F.col(f"{x}_sig").alias("x"), F.col(f"{y}_sig").alias("y")).distinct()


def _compatible(left: DataFrame, right: DataFrame, pairs: DataFrame) -> DataFrame:
    """(group_id, left, sig, trust, taken): for each value of ``left`` the offers of ``right`` that may stand beside it.

    A group has one offer for each value, and one without a value at most.
    """
    a = left.select("group_id", F.col("sig").alias("left"))
    seen = a.join(pairs.withColumnsRenamed({"x": "left", "y": "sig"}), ["group_id", "left"]).join(right, ["group_id", "sig"])
    empty = a.join(right.where("sig = ''"), "group_id")
    free = a.where("left = ''").join(right.where("sig != ''"), "group_id")
    columns = ["group_id", "left", "sig", "trust", "taken"]
    return seen.select(columns).unionByName(empty.select(columns)).unionByName(free.select(columns))


def branch_and_bound(offers: dict[str, list[tuple[float, str, list]]], allowed: dict[tuple[str, str], set[tuple[str, str]]], least: float) -> tuple[float, list] | None:
    """(trust, taken) of the best choice of one offer (trust, value, taken) of each bundle, or None below ``least``.

    ``allowed`` holds the pairs of values of tied bundles; an empty value goes
    with any.  Bundles are decided one after the other, the most trusted offers
    first; a branch ends where its trust and the best of the bundles left
    cannot exceed the best choice so far.
    """
    names = sorted(offers, key=lambda b: (len(offers[b]), b))
    ranked = [sorted(offers[b], key=lambda o: (-o[0], o[2])) for b in names]
    rest = [0.0] * (len(names) + 1)
    for k in reversed(range(len(names))):
        rest[k] = rest[k + 1] + (ranked[k][0][0] if ranked[k] else float("-inf"))
    ties = [[(j, allowed[names[j], names[k]], False) if (names[j], names[k]) in allowed else (j, allowed[names[k], names[j]], True) for j in range(k) if (names[j], names[k]) in allowed or (names[k], names[j]) in allowed] for k in range(len(names))]
    best: list = [least - EPSILON, None]

    def fits(values: list[str], k: int, v: str) -> bool:
        return all(not v or not values[j] or ((v, values[j]) if turned else (values[j], v)) in pairs for j, pairs, turned in ties[k])

    # an explicit stack, as depth first search needs: (bundle, offer, trust, values, taken)
    stack = [(0, 0, 0.0, [], [])]
    while stack:
        k, i, trust, values, taken = stack.pop()
        if k == len(names):
            if trust > best[0]:
                best = [trust, taken]
            continue
        if i >= len(ranked[k]) or trust + ranked[k][i][0] + rest[k + 1] <= best[0]:
            continue
        stack.append((k, i + 1, trust, values, taken))
        own, value, its = ranked[k][i]
        if fits(values, k, value):
            stack.append((k + 1, 0, trust + own, [*values, value], [*taken, *its]))
    return (best[0], best[1]) if best[1] is not None else None


def choose_bundles(records: DataFrame, bundles: list[str], ties: list[tuple[str, str]], root: str) -> DataFrame:
    """(group_id, total, bound, ways, taken): the consistent choice of bundles of greatest total trust in each group.

    ``records``: group_id, id and of each bundle ``_sig`` and ``_trust``.
    ``taken`` lists bundle and id of the record it comes from.  ``bound`` is the
    sum of the best bundles whether they agree or not; ``ways`` counts the
    values of ``root`` with which the total is reached.  Ties go to the smaller
    value of ``root``, then the smaller ids.

    Nothing is gathered by group.  Offers of equal value shrink to the best
    (map-side).  A record's own bundles agree, so the best record is a lower
    bound, and an offer with which even the best of all other bundles stays
    below it is cut.  Bundles tied to one other bundle only are decided for each
    of its values.  The search then branches on ``root``: each of its values is a
    node, bounded by the best offers that agree with it.  Where those agree with
    one another too the node is solved; nodes bounded below the best solved one
    are cut; what is left, a node at a time, goes through
    :func:`branch_and_bound`.
    """
    of = {b: {y if x == b else x for x, y in ties if b in (x, y)} for b in bundles}
    leaves = {b: next(iter(of[b])) for b in bundles if b != root and root not in of[b] and len(of[b]) == 1}
    free = [b for b in bundles if not of[b] and b != root]
    core = [b for b in bundles if b != root and b not in leaves and b not in free]
    if any(root not in of[b] for b in core) or any(y in leaves for y in leaves.values()):
        raise ValueError("every bundle must be tied to the root, to one bundle that is, or to none")

    def tied(x: str, y: str) -> DataFrame:
        return _pairs(records, x, y)

    offers = records.select("group_id", "id", F.inline(F.array(*[F.struct(F.lit(b).alias("bundle"), F.coalesce(F.col(f"{b}_sig"), F.lit("")).alias("sig"), F.col(f"{b}_trust").alias("trust")) for b in bundles])))
    best = offers.groupBy("group_id", "bundle", "sig").agg(F.min(F.struct((-F.col("trust")).alias("t"), "id")).alias("p"))
    best = materialize(best.select("group_id", "bundle", "sig", (-F.col("p.t")).alias("trust"), F.array(F.struct("bundle", F.col("p.id").alias("id"))).alias("taken")), "offers")
    tops = best.groupBy("group_id", "bundle").agg(F.max("trust").alias("top"))
    bounds = tops.groupBy("group_id").agg(F.sum("top").alias("bound"), F.map_from_entries(F.collect_list(F.struct("bundle", "top"))).alias("tops"))
    own = reduce(lambda x, y: x + y, (F.col(f"{b}_trust") for b in bundles))
    limits = materialize(records.groupBy("group_id").agg(F.max(own).alias("floor")).join(bounds, "group_id"), "limits")
    kept = best.join(limits, "group_id").where(F.col("trust") + F.col("bound") - F.col("tops")[F.col("bundle")] >= F.col("floor") - EPSILON)
    kept = materialize(kept.select(best.columns), "kept")
    by = {b: kept.where(F.col("bundle") == b).drop("bundle") for b in bundles}
    first = F.min(F.struct((-F.col("trust")).alias("t"), "taken")).alias("p")
    for leaf, y in leaves.items():
        beside = _compatible(by[y], by[leaf], tied(y, leaf)).groupBy("group_id", F.col("left").alias("sig")).agg(first)
        by[y] = by[y].join(beside, ["group_id", "sig"]).select("group_id", "sig", (F.col("trust") - F.col("p.t")).alias("trust"), F.concat("taken", "p.taken").alias("taken"))
    sides = [_compatible(by[root], by[b], tied(root, b)).withColumn("bundle", F.lit(b)) for b in core]
    beside = materialize(reduce(DataFrame.unionByName, sides), "beside")
    picks = beside.groupBy("group_id", "left", "bundle").agg(F.min(F.struct((-F.col("trust")).alias("t"), "taken", "sig")).alias("p"))
    nodes = picks.groupBy("group_id", "left").agg(F.sum("p.t").alias("t"), F.count(F.lit(1)).alias("n"), F.map_from_entries(F.collect_list(F.struct("bundle", "p.sig"))).alias("sigs"), F.map_from_entries(F.collect_list(F.struct("bundle", -F.col("p.t")))).alias("tops"), F.flatten(F.array_sort(F.collect_list("p.taken"))).alias("others")).where(F.col("n") == len(core))
    nodes = nodes.join(by[root].withColumnRenamed("sig", "left"), ["group_id", "left"]).select("group_id", "left", F.col("trust").alias("own"), (F.col("trust") - F.col("t")).alias("total"), F.concat("taken", "others").alias("taken"), F.col("taken").alias("root"), "sigs", "tops", F.lit(True).alias("agree"))
    inner = [(x, y) for x, y in ties if x in core and y in core]
    for x, y in inner:
        seen = tied(x, y).withColumn("seen", F.lit(True))
        nodes = nodes.withColumns({"x": F.col("sigs")[x], "y": F.col("sigs")[y]}).join(seen, ["group_id", "x", "y"], "left")
        nodes = nodes.withColumn("agree", F.col("agree") & (F.col("seen").isNotNull() | (F.col("x") == "") | (F.col("y") == ""))).drop("x", "y", "seen")
    nodes = materialize(nodes, "nodes")
    solved = nodes.where("agree").select("group_id", "left", "total", "taken")
    if inner:
        solved = solved.unionByName(_searched(nodes, beside, {t: tied(*t) for t in inner}, limits))
    ways = solved.groupBy("group_id", F.round("total", 6).alias("total")).agg(F.count(F.lit(1)).alias("ways"), F.min(F.struct("left", "taken")).alias("w"))
    won = ways.groupBy("group_id").agg(F.max(F.struct("total", "ways", "w")).alias("m")).select("group_id", "m.total", "m.ways", "m.w.taken")
    for b in free:
        alone = by[b].groupBy("group_id").agg(first)
        won = won.join(alone, "group_id").select("group_id", (F.col("total") - F.col("p.t")).alias("total"), "ways", F.concat("taken", "p.taken").alias("taken"))
    return won.join(limits.select("group_id", "bound"), "group_id").select("group_id", "total", "bound", "ways", "taken")


def _searched(nodes: DataFrame, beside: DataFrame, allowed: dict[tuple[str, str], DataFrame], limits: DataFrame) -> DataFrame:
    """(group_id, left, total, taken) of the nodes whose best offers don't agree and that may still win."""
    known = nodes.where("agree").groupBy("group_id").agg(F.max("total").alias("known"))
    # the floor counts bundles outside the nodes too, so only solved nodes bound the rest
    open_ = nodes.where("NOT agree").join(known, "group_id", "left").withColumn("least", F.coalesce("known", F.lit(float("-inf")))).where(F.col("total") >= F.col("least") - EPSILON)
    open_ = materialize(open_.select("group_id", "left", "own", "total", "root", "tops", "least"), "open")
    offers = beside.join(open_, ["group_id", "left"]).where(F.col("trust") + F.col("total") - F.col("tops")[F.col("bundle")] >= F.col("least") - EPSILON)
    offers = materialize(offers.select("group_id", "left", "bundle", "sig", "trust", "taken", "own", "root", "least"), "open")
    rows = offers.withColumns({"x": F.lit(None).cast("string"), "y": F.lit(None).cast("string")})
    for (x, y), pairs in allowed.items():
        sides = [offers.where(F.col("bundle") == b).select("group_id", "left", F.col("sig").alias(c)) for b, c in ((x, "x"), (y, "y"))]
        held = pairs.join(sides[0], ["group_id", "x"]).join(sides[1], ["group_id", "left", "y"]).select("group_id", "left", F.lit(f"{x}|{y}").alias("bundle"), "x", "y")
        rows = rows.unionByName(held, allowMissingColumns=True)
    ties = list(allowed)

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs: dict[tuple[str, str], set] = {t: set() for t in ties}
        found: dict[str, list] = {}
        own = least = 0.0
        root: list = []
        for bundle, sig, trust, taken, o, r, at_least, x, y in zip(*(pdf[c] for c in ("bundle", "sig", "trust", "taken", "own", "root", "least", "x", "y"))):
            if "|" in bundle:
                pairs[tuple(bundle.split("|"))].add((x, y))
            else:
                found.setdefault(bundle, []).append((trust, sig, [(t["bundle"], t["id"]) for t in taken]))
                own, root, least = o, [(t["bundle"], t["id"]) for t in r], at_least
        best = branch_and_bound(found, pairs, least - own)
        out = [] if best is None else [(pdf["group_id"].iloc[0], pdf["left"].iloc[0], own + best[0], [{"bundle": b, "id": i} for b, i in root + best[1]])]
        return pd.DataFrame(out, columns=["group_id", "left", "total", "taken"])

    return rows.groupBy("group_id", "left").applyInPandas(search, "group_id string, left string, total double, taken array<struct<bundle: string, id: string>>")


def golden_records(catalog: DataFrame) -> DataFrame:
    """One built record per group: group_id, survivor_id, members, trust, each bundle's fields and its origin.

    Every bundle comes whole from one record of the group, see
    :func:`choose_bundles`.  Of several rows with one id the best by
    :func:`record_marks` counts.  Groups are those of :func:`tie_works`; works
    tied to nothing are their own survivors and are not listed.  Extra columns
    of the table are ignored.
    """
    groups = materialize(tie_works(catalog), "groups")
    used = list(dict.fromkeys(["classifiedAt", *(c for f in BUNDLES.values() for c in f)]))
    count = reduce(lambda x, y: x + y, (F.when(filled(c), 1).otherwise(0) for c in COMPLETE), F.when(F.size("sourceVariants") > 0, 1).otherwise(0))
    row = F.struct(count.alias("_f"), "classifiedAt", confidence_rank(F.col("confidence")).alias("_c"), *[c for c in used if c != "classifiedAt"])
    one = catalog.where("id IS NOT NULL").groupBy("id").agg(F.max(row).alias("r")).select("id", *[F.col(f"r.{c}").alias(c) for c in used])
    one = materialize(one.join(groups, "id", "left_semi"), "records")
    chosen = materialize(choose_bundles(materialize(bundle_records(one, groups), "bundles"), list(BUNDLES), TIES, ROOT), "chosen")
    source = one.select("id", *[F.col(c) for f in BUNDLES.values() for c in f])
    parts = chosen.select("group_id", F.inline("taken")).join(source, "id")
    fields = [F.first(F.when(F.col("bundle") == b, F.col(c)), ignorenulls=True).alias(c) for b, f in BUNDLES.items() for c in f]
    origin = [F.first(F.when(F.col("bundle") == b, F.col("id")), ignorenulls=True).alias(f"{b}From") for b in BUNDLES]
    members = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("members"))
    return parts.groupBy("group_id").agg(*fields, *origin).join(members, "group_id").join(survivors(one, groups), "group_id").join(chosen.select("group_id", F.round("total", 6).alias("trust")), "group_id")
