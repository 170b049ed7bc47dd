"""Blocks, identity, batches, frontier, units, merged files, audit and lists on small fixtures."""

import random

import pytest
from pyspark.sql import functions as F

from bookloom.functions import blocks as B
from bookloom.functions import identity as I
from bookloom.operators import atlas as A
from bookloom.operators import audit, lists, units
from bookloom.operators.batches import next_fit
from bookloom.operators.frontier import conversion_frontier
from bookloom.operators.ranking import rank_in_groups, running_sums

LONG = "the harbour follows the council and the market of the old town where bridges are built\n"


def test_front_and_end_matter(spark):
    book = ["Copyright 1990\n\nAll rights reserved. ISBN 1", "Contents\n\nContents\nOne 1\nTwo 2\nThree 3", "x\n\n" + LONG * 8, "y\n\n" + LONG * 9, "z\n\n" + LONG * 7, "w\n\nsome words", "v\n\n" + LONG * 5, "u\n\n" + LONG * 8, "t\n\n" + LONG * 8, "End\n\nBibliography\n" + "1. Press, vol. 2\n" * 8]
    rows = [("a", i, t) for i, t in enumerate(book)] + [("b", i, "cover\n\nalso by the author") for i in range(3)] + [("c", 0, None), ("c", 1, "")]
    df = spark.createDataFrame(rows, "book string, i int, text string").withColumn("body", B.heading_and_body(F.col("text"))["body"])
    flags = B.block_flags(df, "body")
    first = {r["i"]: r for r in flags.where("book = 'a'").collect()}
    assert first[0]["frontMatter"] and first[1]["contents"] and first[2]["mainText"] and first[9]["references"] and first[9]["endStart"] and not first[2]["listLike"]
    left = B.without_end(B.without_front(flags, "book", "i"), "book").groupBy("book").agg(F.sort_array(F.collect_list("i")).alias("i")).collect()
    assert {r["book"]: r["i"] for r in left} == {"a": list(range(2, 9)), "c": [0, 1]}


def test_cuts_inside_a_text():
    text = "# T\n\n" + "Contents and copyright of it. " * 8 + "INTRODUCTION what is said Page 4 " + LONG * 60
    assert B.inline_front_cut(text).startswith("# T\n\nINTRODUCTION what")
    assert B.inline_front_cut("INTRODUCTION Page 4 " + LONG * 60).startswith("INTRODUCTION")
    body = LONG * 60
    assert B.inline_end_cut(body + "\n## References\nA. B., 1990\n") == body.strip() and B.inline_end_cut("References\n" + body) == "References\n" + body
    assert B.inline_end_cut(body + "Page 200 INDEX a, b\n\nReferences\n") == body.strip()


def test_cleaning_ends_with_a_short_bibliography(spark):
    df = spark.createDataFrame([(LONG * 3 + "## Sources\nold\n## Sources\nfew words",), (LONG + "## Sources\n" + "w " * 300,), ("",), (None,)], "t string")
    got = [r["x"] for r in df.select(B.finished(F.col("t")).alias("x")).collect()]
    assert got[0].endswith("old") and got[1].endswith("w w") and got[2:] == ["", None]


def test_names_and_keys(spark):
    paths = [("Ann Writer - Old Roads - Part Two.epub", None, None), ("Writer, Ann (12 books)/deep/[Poe, E] Tales (copy 2).md", None, None), ("Writer, Ann/x.y.pdf", "unknown", "Administrator"), ("eBooks of Ann Poe/Tales.md", "Good Title", None), ("The Long Tale by Ann Poe.pdf", None, None), ("", None, None)]
    df = spark.createDataFrame(paths, "p string, t string, a string")
    got = [tuple(r["h"]) for r in df.select(I.name_hints(F.col("p"), F.col("t"), F.col("a")).alias("h")).collect()]
    assert got[0][:2] == ("Ann Writer", "Old Roads - Part Two") and got[1] == ("Poe, E", "Tales", "[Poe, E] Tales", "Writer, Ann (12 books) / deep")
    assert got[2][:2] == ("Writer, Ann", "x.y") and got[3][:2] == ("Ann Poe", "Good Title") and got[4][:2] == ("Ann Poe", "The Long Tale")
    rows = [(None, "Poe, Ann; Bob Lee", "Old Roads of the North: A Story", "book", None), ("a lee | roads", "Poe", "Old Roads", "book", None), (None, "Poe", "Old Roads: vol 2", "book", None), (None, "Poe", "Old Roads, Part 2", "book", None), ("poe | roads (excerpt)", "Poe", "Roads", "article", None), (None, "Poe", "Old Roads Again", "letter", "review of old roads"), (None, None, None, None, None)]
    keys = [r["k"] for r in spark.createDataFrame(rows, "s string, a string, t string, k string, f string").select(I.canonical_key(*[F.col(c) for c in "satkf"]).alias("k")).collect()]
    assert keys == ["ann+lee|old roads of the north", "lee|roads", "poe|old roads vol 2", "poe|old roads part 2", "poe|roads excerpt", "poe|old roads again|paratext review of old roads", "|"]
    named = spark.createDataFrame([("w_00000001", "A - B.md"), ("w_00000002", "a - b.md"), ("w_00000003", "C.md")], "id string, name string")
    assert sorted(r["outputName"] for r in I.unique_names(named, "name", "id").collect()) == ["A - B.md", "C.md", "a - b [00000002].md"]


def test_batches_are_those_of_one_pass(spark):
    random.seed(2)
    sizes = [random.choice([1, 2, 3, 9, 10]) for _ in range(400)]
    got = {r["i"]: r["batch"] for r in next_fit(spark.createDataFrame(list(enumerate(sizes)), "i int, n int"), [F.col("i")], "n", 10).collect()}
    batch, held, want = 1, 0, {}
    for i, n in enumerate(sizes):
        if held and held + n > 10:
            batch, held = batch + 1, 0
        want[i], held = batch, held + n
        if held >= 10:
            batch, held = batch + 1, 0
    assert got == want
    assert next_fit(spark.createDataFrame([], "i int, n int"), [F.col("i")], "n", 10).count() == 0


def test_places_and_sums_in_groups(spark):
    random.seed(3)
    rows = [(random.choice("ab"), random.choice("xyz"), i, random.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, s string, i int, v int")
    order = [F.col("v").desc(), F.col("i")]
    placed = rank_in_groups(df, ["g"], order, out="k", inner={"j": ["s"]}).collect()
    sums = running_sums(df, ["g"], order, {"upto": F.col("v"), "n": F.lit(1)}).collect()
    for g in "ab":
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[3], r[2]))
        assert {r["i"]: r["k"] for r in placed if r["g"] == g} == {r[2]: k for k, r in enumerate(own, 1)}
        assert {r["i"]: (r["upto"], r["n"]) for r in sums if r["g"] == g} == {r[2]: (sum(x[3] for x in own[:k]), k) for k, r in enumerate(own, 1)}
        for s in "xyz":
            assert {r["i"]: r["j"] for r in placed if (r["g"], r["s"]) == (g, s)} == {r[2]: k for k, r in enumerate((r for r in own if r[1] == s), 1)}


WORK = "corpus string, id string, title string, creator string, static double, priority int, role int, relevance int, must boolean, damage double, bytes bigint, tokens bigint, cap double, bundle boolean, topics array<string>, content array<string>, standalone string"


def _work(i, static=50.0, tokens=1000, must=False, standalone="medium", content=()):
    return ("c", i, f"t {i}", f"by {i}", static, 50, 16, 70, must, 0.0, tokens * 4, tokens, None, False, ["x"], [i, *content], standalone)


def test_frontier(spark):
    none = spark.createDataFrame([], "whole string, part string")
    works = spark.createDataFrame([_work(f"w{i:02d}", 80.0 - i) for i in range(20)], WORK)
    out = conversion_frontier(works, none, 5).collect()
    assert len(out) == 20 and sum(r["selected"] for r in out) == 5 and {r["reason"] for r in out} == {"curation_frontier", "preconversion_marginal_value"}
    more = works.unionByName(spark.createDataFrame([_work("new", 1.0)], WORK))
    known, before = works.select("id"), spark.createDataFrame([("w19",), ("gone",)], "id string")
    reasons = {r["id"]: r["reason"] for r in conversion_frontier(more, none, 5, known, before).where("selected").collect()}
    assert reasons["new"] == "newly_added_work" and reasons["w19"] == "previous_final_selection" and len(reasons) == 5
    nested = spark.createDataFrame([_work("whole", 60.0, 2_000_000, content=("part",)), _work("part", 10.0, 100_000, standalone="high"), _work("other", 70.0)], WORK)
    path = spark.createDataFrame([("whole", "part")], "whole string, part string")
    got = {r["id"]: r["reason"] for r in conversion_frontier(nested, path, 2).where("selected").collect()}
    assert got == {"whole": "containment_alternative", "part": "containment_alternative"}
    required = spark.createDataFrame([_work(f"m{i}", must=True) for i in range(4)], WORK)
    assert conversion_frontier(required, none, 2).where("selected AND reason = 'must_include'").count() == 4


def test_atlas_keeps_what_refers_to_works(spark):
    make = spark.createDataFrame
    atlas = A.Atlas(
        make([("a", "first"), ("zz", "lost"), ("b", "second")], "work_id string, reason string"),
        make([("ann", ["a", "b", "zz"], 3), ("nobody", ["a"], 1)], "author_key string, preferred_work_ids array<string>, soft_maximum int"),
        make([("a", ["a", "b", "b"]), ("a2", ["a"]), ("zz", ["zz", "a"])], "representative_work_id string, work_ids array<string>"),
        make([("a", "b"), ("a", "a"), ("a", "zz")], "container_work_id string, contained_work_id string"),
        make([("x", 1), ("y", 2), ("z", 3)], "key string, weight int"),
    )
    works, by = make([("a",), ("b",), (None,)], "id string"), make([("a", "ann"), ("b", "bob")], "id string, key string")
    fixed, warnings = A.repaired_atlas(atlas, works, by)
    A.checked_areas(fixed)
    assert sorted(r["code"] for r in warnings.collect()) == sorted(["unknown_must_include_work", "unknown_author_policy", "unknown_preferred_work", "wrong_author_preferred_work", "invalid_duplicate_group", "invalid_duplicate_group", "invalid_containment_relation", "invalid_containment_relation"])
    assert [r["preferred_work_ids"] for r in fixed.policies.collect()] == [["a"]] and fixed.duplicates.count() == 1 and fixed.containment.count() == 1
    reasons = A.required_reasons(fixed, make([("a", "a"), ("b", "a")], "id string, representative string")).collect()
    assert [tuple(r) for r in reasons] == [("a", "first second")]
    with pytest.raises(ValueError):
        A.checked_areas(A.Atlas(atlas.must, atlas.policies, atlas.duplicates, atlas.containment, atlas.areas.limit(2)))
    old, now = (A.fingerprints(make(rows, "id string, t string"), "id", ["id", "t"]) for rows in ([("a", "x"), ("b", "y"), ("d", "z")], [("a", "x"), ("b", None), ("c", "z")]))
    assert {r["id"]: r["state"] for r in A.additions(old, now).collect()} == {"a": "same", "b": "changed", "c": "added", "d": "gone"}


def test_decisions_are_repaired(spark):
    rows = [("a", "ab", "edition one", "zz", ["b", "a", "zz", "b"], None, ["x", "no"]), ("b", "key", None, "a", [], ["a"], None)]
    decisions = spark.createDataFrame(rows, "id string, identity_group_key string, edition_group_key string, canonical_work_id string, contains_work_ids array<string>, contained_by_work_ids array<string>, topic_keys array<string>")
    rosters = spark.createDataFrame([(i, m) for i in "ab" for m in "ab"], "id string, member string")
    fixed, warnings = A.repaired_decisions(decisions, rosters, spark.createDataFrame([("x",)], "key string"))
    assert {r["id"]: tuple(r)[1:] for r in fixed.collect()} == {"a": ("work-a", "edition one", "a", ["b"], [], ["x"]), "b": ("key", "edition-b", "a", [], ["a"], [])}
    assert sorted(((r["code"], r["subject"], r["value"]) for r in warnings.collect()), key=str) == sorted([("empty_identity_group_key", "a", "ab"), ("empty_edition_group_key", "b", None), ("unknown_canonical_work", "a", "zz"), ("invalid_contains_relation", "a", "a"), ("invalid_contains_relation", "a", "zz"), ("unknown_topic_key", "a", "no")], key=str)
    works = spark.createDataFrame([("a", "ann", "b", None), ("b", "ann", None, "k"), ("c", "ann", None, "k"), ("d", "bob", "a", "k"), ("e", "eve", None, None)], "id string, creator string, canonicalWorkId string, key string")
    groups = spark.createDataFrame([(["d", "e", "gone"],)], "work_ids array<string>")
    assert {r["id"]: r["component"] for r in A.identity_components(works, groups).collect()} == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d"}


@pytest.mark.parametrize("text", ["", "word " * 900, "x" * 5000, "ž" * 3000, "p one two three.\n\n" * 300, "short\n\n" + "y" * 2500 + "\n\nend"])
def test_books_are_split_within_limits(text):
    parts = units.split_book(text, 1000, 200)
    assert all(len(p.encode()) <= 1000 and units.quarter_bytes(p) <= 200 for p in parts)
    assert "".join("".join(parts).split()) == "".join(text.split())


def test_merged_files_and_their_index(spark):
    rows = [("c", 1, "01_a.md", "w1", "Ann", "Old", 1, 2, "w1-1", "### FRONT MATTER: Source opening\n\n[CORPUS_CONTEXT: x]\n\n<a id=\"retrieval-w1-1-a\"></a>\n\n### CHAPTER: One\n\n#### PAGE: 1\n\n[CORPUS_CONTEXT: y]\ntext"), ("c", 2, "02_b.md", "w1", "Ann", "Old", 2, 2, "w1-2", "rest"), ("c", 2, "02_b.md", "w2", None, "New", 1, 1, "w2-1", "## not allowed\n#### PAGE: 9\n" + "x\n" * 9)]
    df = spark.createDataFrame(rows, "corpus string, file int, name string, workId string, author string, title string, unitIndex int, unitCount int, anchor string, content string")
    bodies = units.merged_bodies(df)
    text = {r["name"]: r["text"] for r in bodies.collect()}
    assert text["01_a.md"].startswith("# CORPUS FILE: 01_a.md\n") and "- [CHAPTER: One](#retrieval-w1-1-a)" in text["01_a.md"] and text["02_b.md"].index("BOOK: New") < text["02_b.md"].index("BOOK: Ann — Old (2/2)")
    assert {(r["name"], r["problem"]) for r in units.merged_problems(bodies).collect()} == {("02_b.md", "nested_heading"), ("02_b.md", "boundary_without_context")}
    index = units.corpus_index(df)
    expected = df.select("corpus", F.concat_ws("#", "name", "anchor").alias("target"))
    assert units.target_differences(expected, units.index_targets(index)).count() == 0
    assert units.target_differences(expected, units.index_targets(index).limit(2)).count() == 1
    assert {r["workId"]: r["places"] for r in units.locations(df).collect()}["w1"] == ["01_a.md#w1-1", "02_b.md#w1-2"]


def test_merged_files_are_written_within_the_limit(spark, tmp_path):
    df = spark.createDataFrame([("c", "01.md", "one\ntwo")], "corpus string, name string, text string")
    units.write_merged(df, str(tmp_path / "out"), 100)
    assert next((tmp_path / "out" / "corpus=c" / "name=01.md").glob("*.txt")).read_text() == "one\ntwo\n"
    with pytest.raises(Exception, match="7 bytes"):
        units.write_merged(df, str(tmp_path / "no"), 5)


def test_token_counts(spark):
    df = spark.createDataFrame([("one two",), (None,)], "t string").select(units.token_counts(F.col("t"), {"words": lambda t: len(t.split()), "bytes": units.quarter_bytes}).alias("c"))
    assert [r["m"] for r in df.select(units.most_tokens(F.col("c")).alias("m")).collect()] == [2, 0]
    assert units.longest_prefix("vědomí " * 200, lambda t: len(t) <= 40) == 40 and units.longest_prefix("", bool) == 0


def test_audit_codes(spark):
    t = lambda rows, schema: spark.createDataFrame(rows, schema)
    ids = lambda *x: t([("c", i) for i in x], "corpus string, id string")
    corpora, names = t([("c",), ("d",)], "corpus string"), lambda *x: t([("c", n) for n in x], "corpus string, name string")
    staged = t([("c", "a", "s/a", "a.md", "a.md"), ("c", "b", "s/none", "b.md", "b.md")], "corpus string, id string, source string, name string, markdown string")
    found = t([("c", "1.md", 10, 5), ("c", "2.md", 99, 99), ("c", "old.md", 1, 1)], "corpus string, name string, bytes int, tokens int")
    links = t([("c", "1.md", "x"), ("c", "1.md", "lost"), ("c", "gone.md", "y"), ("c", "3.md", "z")], "corpus string, name string, anchor string")
    issues = [
        audit.catalog_issues(t([("a", "c", ["low"]), ("b", "other", ["low"]), ("d", "c", None)], "id string, target string, reviewFlags array<string>"), ["c"]),
        audit.coverage_issues(t([("f1",), ("f2",)], "id string"), t([("f1",)], "id string"), corpora, t([("c",)], "corpus string")),
        audit.plan_issues(ids("a", "b"), ids("a", "b", "gone"), ids("a", "extra"), t([("a", "d")], "id string, target string"), t([("c", 7)], "corpus string, total int")),
        audit.conversion_issues(staged, t([("s/a",)], "path string"), names("a.md"), t([("c", "a.md", ["too_small"]), ("c", "stray.md", [])], "corpus string, name string, flags array<string>")),
        audit.selection_issues(ids("a", "z"), ids("b"), ids("a", "b"), ids("a"), t([("a", "k"), ("z", "k")], "id string, content string")),
        audit.file_issues(corpora, names("1.md", "2.md", "3.md"), found, {"files": 2, "knowledgeFiles": 4, "reserved": 2, "bytes": 50, "tokens": 50}),
        audit.report_issues(t([("c", True, False, True), ("d", True, True, None)], "corpus string, fileCountWithinLimit boolean, fileSizeWithinLimit boolean, tokenCountWithinLimit boolean")),
        audit.index_issues(corpora, t([("c", "# c\n")], "corpus string, text string"), links, names("1.md", "2.md", "3.md"), names("1.md", "2.md"), t([("c", "1.md", "x")], "corpus string, name string, anchor string")),
    ]
    every = issues[0]
    for more in issues[1:]:
        every = every.unionByName(more)
    got = sorted((r["code"], r["subject"]) for r in every.collect())
    assert got == sorted([
        ("catalog_review_flag", "a"), ("classification_incomplete", "f2"), ("curation_incomplete", "d"), ("stale_conversion_plan_entry", "gone"), ("unstaged_work", "b"), ("unplanned_staged_work", "extra"), ("wrong_target_folder", "a"), ("wrong_target_folder", "extra"), ("stale_conversion_plan_count", "c"),
        ("missing_source", "b"), ("missing_staged_file", "b"), ("conversion_failed", "b"), ("markdown_quality", "a:too_small"), ("orphaned_markdown", "stray.md"), ("selected_unconverted_work", "z"), ("selected_containment_overlap", "a|z"), ("incomplete_merge_accounting", "c"),
        ("missing_merge_report", "d"), ("missing_merged_file", "3.md"), ("orphaned_merged_file", "old.md"), ("too_many_upload_files", "3"), ("too_many_total_knowledge_files", "3"), ("upload_file_too_large", "2.md"), ("upload_file_too_many_tokens", "2.md"), ("merge_validation_failed", "c"), ("merge_token_count_failed", "d"),
        ("missing_embedded_index", "d"), ("stale_index_file_link", "gone.md"), ("broken_index_file_link", "3.md"), ("broken_index_anchor", "1.md#lost"), ("unlinked_final_file", "2.md"),
    ])
    counts = audit.issue_counts(every).first()
    assert counts["errors"] + counts["warnings"] == len(got) and not counts["ok"] and audit.rendered(every).first()["value"].startswith("- **ERROR ")


def test_outcomes(spark):
    works = spark.createDataFrame([(i, "a", "t", "null" if i == "o" else "c") for i in "odsxmn"], "id string, author string, title string, target string")
    portfolio = spark.createDataFrame([("d", "s", "r"), ("s", "s", "r")], "id string, canonicalWorkId string, reason string")
    one = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    report = audit.decisions_report(works, portfolio, one("s"), spark.createDataFrame([("x", "capacity")], "id string, exclusionReason string"), one("s", "m"))
    assert {r["id"]: r["outcome"] for r in report.collect()} == {"o": "outside", "d": "exact_duplicate", "s": "selected", "x": "excluded", "m": "converted", "n": "not_converted"}


def test_lists_are_in_czech_order(spark):
    rows = [("c", "1", "Čapek", "Díl 10", ""), ("c", "2", "Cech", "B", "capacity"), ("c", "3", "Čapek", "Díl 9", ""), ("c", "4", None, None, None), ("c", "5", "Chalupa", "A", "")]
    text = lists.written_list(lists.book_list(spark.createDataFrame(rows, "corpus string, id string, author string, title string, reason string")))
    assert text.first()["text"].split("\n") == ["", "  - ", "", "Cech", "  - B [capacity]", "", "Čapek", "  - Díl 9", "  - Díl 10", "", "Chalupa", "  - A", ""]
    assert {(r["author"], r["title"]) for r in lists.read_list(text).collect()} == {("Cech", "B"), ("Čapek", "Díl 9"), ("Čapek", "Díl 10"), ("Chalupa", "A")}
