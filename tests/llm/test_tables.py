"""Survivors, caps and splits against brute force, with the awkward inputs each must bear."""

import datetime as dt
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookloom.llm import caps, split, survivor
from bookloom.llm.tokens import encoder

VARIANT = "struct<fileId: string, relativePath: string, extension: string, size: bigint, sha256: string, exactDuplicateOfPrimary: boolean, classificationLanguage: string, classificationPriorityScore: int, classificationConfidence: string>"
CATALOG = f"id string, canonicalKey string, author string, title string, language string, contentType string, summaryCz string, target string, relevanceScore int, priorityScore int, confidence string, reasonCz string, editionNote string, evidence string, canonicalWorkId string, editionGroupKey string, sourceVariants array<{VARIANT}>, classifiedAt timestamp, group_id string, node string"
NAMES = [c.split()[0] for c in CATALOG.split(f"array<{VARIANT}>")[0].split(", ")] + ["classifiedAt", "group_id", "node"]
T0 = dt.datetime(2024, 1, 1)


def _record(i, **more):
    base = dict.fromkeys(NAMES) | {"id": i, "group_id": "other", "node": "clash"}
    return tuple((base | more)[n] for n in NAMES)


def _variant(sha, size=10):
    return ("f", "p", ".md", size, sha, False, "en", 1, "high")


def test_ties_and_survivor(spark):
    rows = [
        _record("a", editionGroupKey=" Key-1 ", author="A", title="T", classifiedAt=T0, confidence="high"),
        _record("b", editionGroupKey="key-1", author="A", title="unknown", classifiedAt=T0, confidence="low"),
        _record("c", sourceVariants=[_variant("h1")], canonicalWorkId="b"),
        _record("d", sourceVariants=[_variant("h1"), _variant("h0", 0)]),
        _record("e", sourceVariants=[_variant("h0", 0)], editionGroupKey="n/a"),
        _record("f", editionGroupKey="n/a", canonicalWorkId="nowhere"),
        _record("g", canonicalWorkId="nowhere", sourceVariants=[]),
        _record(None, editionGroupKey="key-1"),
    ]
    catalog = spark.createDataFrame(rows + rows[:2], CATALOG)
    groups = {r["id"]: r["group_id"] for r in survivor.tie_works(catalog).collect()}
    assert groups == dict.fromkeys("abcd", "a")
    out = survivor.survivors(catalog).collect()
    assert [(r["group_id"], r["survivor_id"]) for r in out] == [("a", "a")]
    assert [tuple(r) for r in survivor.undisputed(catalog).collect()] == [("a", "a")]
    # two records that are best in every mark, and one best in each
    equal = [_record("p", editionGroupKey="k", title="T", confidence="low"), _record("q", editionGroupKey="k", title="T", confidence="low"), _record("r", editionGroupKey="l", title="T"), _record("s", editionGroupKey="l", confidence="high")]
    assert survivor.undisputed(spark.createDataFrame(equal, CATALOG)).count() == 0
    built = survivor.golden_records(catalog).collect()[0]
    assert built["author"] == "A" and built["title"] == "T" and built["members"] == 4 and built["sourcesFrom"] in ("c", "d")
    assert survivor.golden_records(catalog.limit(0)).count() == 0 == survivor.survivors(catalog.limit(0)).count()


def test_bundles_are_the_best_consistent_choice(spark):
    random.seed(1)
    rows = []
    for g in range(14):
        for i in range(random.randrange(1, 8)):
            rows.append((f"g{g}", f"r{i}", *(x for b in survivor.BUNDLES for x in ("" if b == "judgement" else random.choice(["", "x", "y", "z"]), float(random.choice([0, 100, 200, 300]) + random.randrange(9))))))
    names = [f"{b}_{x}" for b in survivor.BUNDLES for x in ("sig", "trust")]
    records = spark.createDataFrame(rows, "group_id string, id string, " + ", ".join(f"{n} {'string' if n.endswith('sig') else 'double'}" for n in names))
    got = {r["group_id"]: r for r in survivor.choose_bundles(records, list(survivor.BUNDLES), survivor.TIES, survivor.ROOT).collect()}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append({"id": r[1]} | dict(zip(names, r[2:])))
    order = list(survivor.BUNDLES)

    def agree(g, values):
        return all(not values[x] or not values[y] or any(m[f"{x}_sig"] == values[x] and m[f"{y}_sig"] == values[y] for m in by[g]) for x, y in survivor.TIES)

    for g, members in by.items():
        best = 0.0
        for choice in itertools.product(members, repeat=len(order) - 1):  # judgement is tied to nothing
            values = {b: m[f"{b}_sig"] for b, m in zip(order, choice)}
            total = sum(m[f"{b}_trust"] for b, m in zip(order, choice))
            if total > best and agree(g, values):
                best = total
        best += max(m["judgement_trust"] for m in members)
        taken = {t["bundle"]: next(m for m in members if m["id"] == t["id"]) for t in got[g]["taken"]}
        assert set(taken) == set(order) and agree(g, {b: m[f"{b}_sig"] for b, m in taken.items()})
        assert sum(m[f"{b}_trust"] for b, m in taken.items()) == pytest.approx(best) == pytest.approx(got[g]["total"])
    assert set(got) == set(by) and survivor.choose_bundles(records.limit(0), list(survivor.BUNDLES), survivor.TIES, survivor.ROOT).count() == 0


def test_branch_and_bound_matches_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        offers = {b: [(float(rng.randrange(20)), v, [(b, v)]) for v in rng.sample(["", "x", "y", "z"], rng.randrange(1, 5))] for b in "abc"}
        allowed = {t: {(x, y) for x in "xyz" for y in "xyz" if rng.random() < 0.4} for t in (("a", "b"), ("c", "a"), ("b", "c"))}
        fits = lambda pick: all(not pick[s][1] or not pick[t][1] or (pick[s][1], pick[t][1]) in pairs for (s, t), pairs in allowed.items())
        totals = [sum(o[0] for o in choice) for choice in itertools.product(*offers.values()) if fits(dict(zip("abc", choice)))]
        got = survivor.branch_and_bound(offers, allowed, 0.0)
        assert (got is None and not totals) or got[0] == max(totals)


def test_apportion():
    assert caps.apportion(5, np.array([4, 4, 2]), np.array([4.0, 4.0, 2.0])).tolist() == [2, 2, 1]
    assert caps.apportion(6, np.array([1, 1, 9]), np.array([1.0, 1.0, 1.0])).tolist() == [1, 1, 4]
    assert caps.apportion(0, np.array([3]), np.array([1.0])).tolist() == [0]
    for _ in range(50):
        n = np.random.default_rng(_).integers(0, 9, 5)
        out = caps.apportion(12, n, np.sqrt(n))
        assert out.sum() == min(12, n.sum()) and (out <= n).all()


def _decisions(spark, rows):
    names = "runId string, id string, corpus string, creatorKey string, priorityScore double, authorSoftMaximum int, contentType string, decidedAt timestamp, loadedAt timestamp, _part int, slots string"
    return spark.createDataFrame([(*r, 1, "x") for r in rows], names)


def test_caps(spark):
    rows = [("r1", f"w{i:03d}", "c", " Big  Name " if i % 2 else "big name", float(i % 7) if i % 5 else None, 3 if i == 4 else None, "book", T0, T0) for i in range(60)]
    rows += [("r1", "w001", "c", "big name", 99.0, None, "book", T0 + dt.timedelta(1), T0), ("r1", "n1", "c", None, 1.0, 1, "book", T0, T0), ("r1", "n2", "c", "  ", 1.0, 1, "book", None, None)]
    out = caps.cap_decisions(_decisions(spark, rows + rows[:3])).collect()
    kept = sorted(r["id"] for r in out if r["kept"])
    want = sorted((i for i in range(60) if i != 1 and i % 5), key=lambda i: (-(i % 7), i))[:2]
    assert kept == sorted(["n1", "n2", "w001", *[f"w{i:03d}" for i in want]])
    counted = caps.counted_decisions(_decisions(spark, rows))
    order = [F.col("priorityScore").desc_nulls_last(), F.col("id").asc()]
    halves = F.when(F.col("id") < "w030", "early").otherwise("late")
    parted = caps.cap_contributors(counted, ["runId", "corpus", "creator"], "authorSoftMaximum", halves, order).where("creator = 'big name' AND kept").groupBy("stratum").count().collect()
    assert sum(r["count"] for r in parted) == 3 and len(parted) == 2
    assert caps.cap_decisions(_decisions(spark, rows).limit(0)).count() == 0


def test_merit_keeps_the_best_of_each_contributor_and_shares_are_met(spark):
    random.seed(9)
    rows = [(s, c, f"{s}{c}{i}", random.randrange(5), random.choice("xyz"), 4 if c == "a" else None) for s in "pq" for c, n in (("a", 30), ("b", 9), ("c", 3), ("d", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "s string, c string, id string, q int, kind string, cap int")
    order = [F.col("q").desc(), F.col("id").asc()]
    kept = {r["id"] for r in caps.cap_contributors(df, ["s", "c"], "cap", F.col("kind"), order, exponent=None).where("kept").collect()}
    want = set()
    for s in "pq":
        for c in "abcd":
            own = sorted((r for r in rows if r[0] == s and r[1] == c), key=lambda r: (-r[3], r[2]))
            want |= {r[2] for r in (own[:4] if c == "a" else own)}
    assert kept == want
    none = df.withColumn("cap", F.lit(None).cast("int"))
    for share in (0.3, 0.4, 0.5, 0.9):
        out = caps.cap_contributors(none, ["s", "c"], "cap", F.lit("all"), order, share=share).where("kept").groupBy("s", "c").count().collect()
        sizes = [30, 9, 3, 1]
        most = max((c for c in range(1, 31) if c <= share * sum(min(n, c) for n in sizes)), default=1)
        assert sorted(r["count"] for r in out) == sorted([min(n, most) for n in sizes] * 2)


@pytest.mark.parametrize("text", ["", "word " * 3000, "x" * 20000, "ž" * 9000, "A line.\n" * 2000, "p one.\n\n" * 1500, "\n" * 7000, "😀" * 4000])
def test_pieces_cover_and_fit(text):
    pieces = split.cut_text(text, 6000, 64, encoder())
    assert "".join(text[s:e] for _, s, e, _ in pieces) == text
    assert all(len(text[a:e].encode()) <= 6000 and a <= s for a, s, e, _ in pieces)
    assert len(pieces) == 1 or all(a < s for a, s, _, n in pieces[1:]) and all(0 < n <= 64 for *_, n in pieces[1:])


def test_cuts_fall_at_the_strongest_pause():
    text = "word " * 700 + "\n\n" + "more " * 700
    (s, e), _ = split.bisect(text, 6000)
    assert text[:e].rstrip() == ("word " * 700).rstrip()


def test_largest_block():
    assert split.largest_block("ab\ncd\n \t\r\nefghi\r\n") == 5
    assert split.largest_block("") == 0 == split.largest_block("\n \n")
    assert split.largest_block("žž\nž") == 7


def test_units_are_numbered_anew(spark):
    rows = [("w", 2, "c", "t", "b " * 4000, T0), ("w", 1, "c", "t", "a " * 10, T0), ("w", 1, "c", "t", "a " * 10, T0), ("v", 1, None, None, None, None), (None, 1, "c", "t", "z", T0)]
    units = spark.createDataFrame(rows, "workId string, unitIndex bigint, corpus string, title string, content string, loadedAt timestamp")
    limits = spark.createDataFrame([("c", "large", 1000, 16)], "corpus string, profile string, capacity_tokens bigint, overlap_tokens bigint")
    out = split.split_units(units, limits).orderBy("workId", "unitIndex").collect()
    own = [r for r in out if r["workId"] == "w"]
    assert [r["unitIndex"] for r in own] == list(range(1, len(own) + 1)) and {r["unitCount"] for r in own} == {len(own)}
    assert "".join(r["content"][r["overlapChars"] :] for r in own) == "a " * 10 + "b " * 4000
    assert max(r["bytes"] for r in own) <= 6000 and len(out) == len(own) + 1
    assert split.split_units(units.limit(0), limits).count() == 0
