"""Scans, EPUB sections, JSON tables and arriving files."""

import zipfile

import pytest
from pyspark.sql import functions as F

from bookloom.operators import tables
from bookloom.sources import classifiers, files
from bookloom.streaming import incremental


def _epub(path):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("OEBPS/book.opf", '<package><metadata><dc:title>A &amp; B</dc:title><dc:creator>Ann</dc:creator><dc:creator>Bob</dc:creator></metadata><manifest><item id="x" href="two.xhtml"/><item id="y" href="one.xhtml"/></manifest><spine><itemref idref="x"/><itemref idref="y"/></spine></package>')
        z.writestr("OEBPS/one.xhtml", "<html><head><title>no</title></head><body><p>too short</p></body></html>")
        z.writestr("OEBPS/two.xhtml", "<body><h1>Head</h1><p>" + "word &eacute; " * 8 + "</p></body>")


def test_scan_and_epub(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    (tmp_path / "a b" / "Book.MD").write_text("---\ntitle: 'My Title'\nauthor: Ann\n---\n# Other\n")
    (tmp_path / "x.txt").write_text("no")
    _epub(tmp_path / "good.epub")
    (tmp_path / "bad.epub").write_bytes(b"junk")
    rows = {r["relativePath"]: r for r in files.scan(spark, str(tmp_path)).collect()}
    assert set(rows) == {"a b/Book.MD", "good.epub", "bad.epub"} and rows["a b/Book.MD"]["extension"] == ".md"
    assert [(r["title"], r["author"]) for r in files.heads(spark, str(tmp_path)).collect()] == [("My Title", "Ann")]
    s = files.epub_sections(spark, str(tmp_path))
    good = {r["ordinal"]: r for r in s.where("error IS NULL").collect()}
    assert good[1]["text"].startswith("Head\n\nword é") and good[1]["title"] == "A & B" and good[1]["author"] == "Ann; Bob"
    assert s.where("error IS NOT NULL").count() == 1
    md = {r["path"].rsplit("/", 1)[1]: r for r in files.epub_markdown(s).collect()}
    assert md["good.epub"]["sections"] == 1 and md["bad.epub"]["markdown"] is None
    now = files.scan(spark, str(tmp_path))
    assert files.unchanged(now, now).where("NOT reuse").count() == 0 and files.unchanged(now, now.limit(0)).where("reuse").count() == 0


def test_json_is_rewritten_only_when_it_changes(spark, tmp_path):
    path = str(tmp_path / "t.json")
    df = spark.createDataFrame([(1, "a", "t0"), (2, None, "t0")], "id bigint, v string, at string")
    assert files.write_if_changed(df, path, ["at"]) and not files.write_if_changed(df.replace("t0", "t1"), path, ["at"])
    assert files.write_if_changed(df.replace("a", "b"), path, ["at"])
    assert {r["v"] for r in files.read_json(spark, path, "id bigint, v string, at string").collect()} == {"b", None}
    assert files.read_json(spark, path + "x", "id bigint").count() == 0
    new = spark.createDataFrame([(2, "z", "t2"), (3, "y", "t2")], "id bigint, v string, at string")
    assert {(r["id"], r["v"]) for r in files.upsert(df, new, ["id"]).collect()} == {(1, "a"), (2, "z"), (3, "y")}


def test_arrivals_are_measured_once(spark, tmp_path):
    source, sink, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for batch in ([(1, "one two"), (2, "x " * 2000)], [(3, "three")]):
        spark.createDataFrame(batch, "doc_id bigint, text string").write.mode("append").parquet(source)
        incremental.measure_arrivals(spark, source, sink, state).awaitTermination()
    rows = {r["doc_id"]: r for r in spark.read.parquet(sink).collect()}
    assert len(rows) == 3 == spark.read.parquet(sink).count() and rows[2]["reasons"] == [] and rows[1]["words"] == 2


def test_heads_samples_and_pages(spark, tmp_path):
    (tmp_path / "a.md").write_text("# Žlutý " + "x" * 90_000)
    (tmp_path / "b.pdf").write_bytes(b"one two three|four five six|seven eight nine ten|x|y|last words")
    (tmp_path / "c.pdf").write_bytes(b"few|words")
    (tmp_path / "d.pdf").write_bytes(b"ok|BROKEN")
    assert {len(r["head"]) for r in files.beginnings(spark, str(tmp_path), "md", 100).collect()} == {100}
    assert files.markdown_samples(spark, str(tmp_path), 9).first()["sample"] == "# Žlutý x"

    def reader(content):
        for page in content.decode().split("|"):
            if page == "BROKEN":
                raise OSError("no page")
            yield page

    pages = files.pdf_pages(spark, str(tmp_path), reader)
    made = {r["path"].rsplit("/", 1)[1]: r for r in files.pdf_markdown(pages).collect()}
    assert made["b.pdf"]["markdown"].startswith("## Page 1\n\none two three\n\n## Page 2") and made["b.pdf"]["error"] is None
    assert made["c.pdf"]["error"] == "fewer than ten words" and made["d.pdf"]["markdown"] is None and "no page" in made["d.pdf"]["error"]
    assert {r["sample"] for r in files.pdf_samples(pages).collect()} == {"one two three\n\nfour five six\n\nseven eight nine ten\n\nx\n\nlast words", "few\n\nwords"}
    assert [r["relativePath"] for r in files.by_format(files.scan(spark, str(tmp_path))).orderBy("place").collect()] == ["a.md", "b.pdf", "c.pdf", "d.pdf"]


def test_nested_volatile_fields_and_stopped_writers(spark, tmp_path):
    rows = lambda at: spark.sql(f"SELECT 1 AS id, named_struct('at', '{at}', 'v', 2, 'in', array(named_struct('at', '{at}', 'w', 3))) AS s")
    assert files.without_keys(rows("t"), ["at"]).schema.simpleString() == "struct<id:int,s:struct<v:int,in:array<struct<w:int>>>>"
    path = str(tmp_path / "t.json")
    assert files.write_if_changed(rows("t0"), path, ["at"]) and not files.write_if_changed(rows("t1"), path, ["at"])
    (tmp_path / "t.json").rename(tmp_path / "t.json.old")
    assert files.read_json(spark, path, rows("x").schema).count() == 1
    new = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, "c", 1)], "id int, v string, n int")
    assert [tuple(r) for r in files.upsert(new.limit(0), new, ["id"], ["n"]).collect()] == [(1, "a", 9)]
    files.write_routed(spark.createDataFrame([(1, "x"), (2, None)], "id int, g string"), str(tmp_path / "r"), F.col("g"))
    assert {p.name for p in (tmp_path / "r").glob("readyGroup=*")} == {"readyGroup=x", "readyGroup=unclassified"}
    assert files.remove_orphans(spark, str(tmp_path / "r"), {"readyGroup=x"}) == ["readyGroup=unclassified"] and files.remove_orphans(spark, str(tmp_path / "no"), set()) == []
    scanned = spark.createDataFrame([("A.md", 1), ("a.MD", 0)], "relativePath string, size int")
    assert {tuple(r) for r in files.preflight(scanned).collect()} == {("empty_file", "a.MD"), ("name_collision", "a.md")} and files.preflight(scanned.limit(0)).first()["problem"] == "no_files"
    files.write_text(spark.createDataFrame([("n", "a\nb")], "name string, text string"), str(tmp_path / "txt"))
    assert next((tmp_path / "txt" / "name=n").glob("*.txt")).read_text() == "a\nb\n"


def test_classifier_plug_ins(spark):
    schema = "source string, author string, title string, summary string, target string, confidence double, reason string"
    works = spark.createDataFrame([("d/one.md",), ("two.md",)], "source string")
    good = [("d/one.md", " Ann ", None, None, "c", 0.5, None), ("two.md", None, "T", "s", "null", 1.0, "r"), ("else.md", None, None, None, "c", 0.1, None)]
    take = lambda rows: classifiers.classified(works, classifiers.from_metadata(spark.createDataFrame(rows, schema)), ["c", "null"])
    made = {r["source"]: r for r in take(good).collect()}
    assert made["d/one.md"]["title"] == "one" and made["d/one.md"]["author"] == "Ann" and set(made) == {"d/one.md", "two.md"}
    for bad, why in ((good[:1], "missing"), ([*good, good[0]], "repeated"), ([("d/one.md", None, None, None, "x", 0.5, None), good[1]], "target"), ([good[0], ("two.md", None, None, None, "c", 1.5, None)], "confidence")):
        with pytest.raises(classifiers.InvalidDecisions, match=why):
            take(bad)
    numbered = spark.createDataFrame([(f"{k}", k) for k in range(1, 8)], "source string, place int")

    def fragile(some):
        rows = some.collect()
        if len(rows) > 2:
            raise OSError("too many")
        return spark.createDataFrame([(r["source"], None, None, None, "c", 0.5, None) for r in rows], schema)

    batches = list(classifiers.classified_in_batches(numbered, fragile, ["c"], "place", 4))
    assert [d.count() for d in batches] == [2, 2, 2, 1]
    answers = [('{"output_text": "a"}',), ('{"output": [{"content": [{"type": "x", "text": "n"}, {"type": "output_text", "text": "b"}]}]}',), ("{}",), ("junk",)]
    assert [r["t"] for r in spark.createDataFrame(answers, "response string").select(classifiers.response_text().alias("t")).collect()] == ["a", "b", None, None]
    total = {r["target"]: r["works"] for r in classifiers.summary(take(good), works.union(spark.createDataFrame([("three",)], "source string"))).collect()}
    assert total == {"c": 1, "null": 1, "unclassified": 1, "all": 2}


def test_checked_joins(spark):
    t = spark.createDataFrame
    a, b = t([(1, "x"), (2, "y")], "k int, v string"), t([(1, "p"), (2, "q"), (3, "r")], "k int, w string")
    assert tables.matched(a, b, ["k"]).count() == 2 and tables.all_matched(a, b, ["k"]).count() == 2
    with pytest.raises(tables.Unmatched):
        tables.matched(b, a, ["k"])
    assert tables.all_matched(b, a, ["k"]) is None
    assert {tuple(r) for r in tables.later_wins([a, t([(2, "z")], "k int, v string")], ["k"]).collect()} == {(1, "x"), (2, "z")}
    assert {tuple(r) for r in tables.replace_part(a, t([(7, "x"), (8, "y")], "k int, v string"), "v", ["x"]).collect()} == {(7, "x"), (2, "y")}
    assert [r["k"] for r in tables.pending(a, t([(1, "x"), (2, "old")], "k int, v string"), ["k", "v"]).collect()] == [2]
    state = "k int, size int, at double, failed boolean, skipped boolean"
    now = t([(1, 5, 1.0, None, None), (2, None, 1.0, None, None), (3, 5, 1.0, None, None), (4, 5, 1.0, None, None)], state)
    before = t([(1, 5, 1.4, None, False), (2, None, 1.0, None, None), (3, 5, 3.0, None, None), (4, 5, 1.0, True, None)], state)
    assert {r["k"]: r["reuse"] for r in tables.reusable(now, before, ["k"], ["size"], ["at"]).collect()} == {1: True, 2: True, 3: False, 4: False}
    assert sorted(r["k"] for r in tables.within_budget(t([(k, k) for k in range(1, 9)], "k int, n int"), [F.col("k")], "n", 10).collect()) == [1, 2, 3, 4]
    assert tuple(spark.range(1).select(tables.progress(F.lit(1), F.lit(4), F.lit(30.0)).alias("p")).first()["p"]) == (25.0, 90.0)


def test_functions_in_sql(spark):
    from bookloom.functions import sql
    from bookloom.functions import text as T

    assert "word_count" in sql.register(spark)
    row = spark.sql("SELECT word_count('a  b') AS w, squeezed(' a   b ') AS s, token_estimate('abcde') AS t, quality_reasons('x') AS q, stable_id('f', 'x') AS i, decoding_signals('Ãx') AS d, payload_hash('# h\\na') = payload_hash('a') AS p").first()
    assert tuple(row)[:4] == (2, "a b", 2, ["too_small", "too_few_words"]) and row["i"].startswith("f_") and row["d"] == 1 and row["p"]
    assert [tuple(r) for r in spark.sql("SELECT l.* FROM (SELECT 'a\\nb' AS t) x, LATERAL lines_of(x.t) l").collect()] == [(1, "a"), (2, "b")]
    times = spark.createDataFrame([(12e3,), (125e3,), (3665e3,), (float("nan"),), (-1.0,)], "ms double").select(T.duration(F.col("ms")).alias("d"))
    assert [r["d"] for r in times.collect()] == ["12s", "2m 5s", "1h 1m 5s", "unknown", "unknown"]
    sample = spark.createDataFrame([("<script>no</script><p>A *b*\n c</p>",)], "t string").select(T.extracted_sample(F.col("t")).alias("s")).first()
    assert sample["s"] == "A b c"
