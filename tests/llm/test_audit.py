"""Flags of texts, and audit rows that have them wrong."""

from bookloom.llm import quality


def test_wrong_flags_of_an_audit_are_shown(spark):
    long = "word " * 400
    texts = {1: long, 2: "PRAISE FOR it\n" + long, 3: long + "also of interest", 4: "short", 5: long + "â€" * 21, 6: None, 7: "PRAISE FOR " + long * 4, 8: long * 4 + "\U0001f600" * 2500 + "."}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    made = quality.quality(docs, quality.LineModel.starting())
    got = {r["doc_id"]: (r["bytes"], r["flags"]) for r in made.select("doc_id", "bytes", "flags").collect()}
    assert {i: f for i, (_, f) in got.items()} == {1: [], 2: ["frontmatter_noise"], 3: ["endmatter_marketing"], 4: ["too_small", "too_few_words"], 5: ["heavy_mojibake"], 6: ["too_small", "too_few_words"], 7: ["frontmatter_noise"], 8: []}
    assert got[5][0] == len(texts[5].encode()) and got[6][0] == 0
    audit = [(1, 2000, 400, 0, ["too_small"]), (2, 2014, 402, 0, ["frontmatter_noise"]), (3, None, None, None, None), (4, 6, 2, 1, ["too_few_words", "too_small"]), (9, 1, 1, 1, [])]
    rows = spark.createDataFrame(audit, "doc_id bigint, bytes bigint, words bigint, replacementCharacters bigint, flags array<string>").selectExpr("*", "current_timestamp() AS auditedAt")
    out = {r["doc_id"]: r["differs"] for r in quality.audit_differences(made, rows.unionByName(rows)).collect()}
    # text 2 has 403 words, three of them in its first line
    assert out == {1: ["flags"], 2: ["words"], 3: [], 4: ["bytes", "words", "replacementCharacters"], 9: None}
