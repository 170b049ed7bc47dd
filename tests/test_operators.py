"""Core operators against brute force and stated expectations."""

import random

import pytest
from pyspark.sql import functions as F

from bookloom.functions import keys as K
from bookloom.functions import text as T
from bookloom.operators import buckets, closure
from bookloom.operators.graph import components, star_edges
from bookloom.operators.ranking import rank_in_groups
from bookloom.operators.select import choose


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {x: find(x) for x in list(parent)}


def test_components_match_union_find(spark):
    random.seed(3)
    edges = [(f"n{random.randrange(300):03d}", f"n{random.randrange(300):03d}") for _ in range(200)] + [(f"p{i:03d}", f"p{i + 1:03d}") for i in range(60)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges + edges[:20], "a string, b string")).collect()}
    want = _union_find([e for e in edges if e[0] != e[1]])
    assert got == want


def test_star_edges_tie_hot_keys_and_skip_nulls(spark):
    rows = [(f"n{i:04d}", "hot") for i in range(500)] + [("x", None), (None, "hot"), ("lone", "k")]
    got = components(star_edges(spark.createDataFrame(rows, "node string, key string")))
    assert got.groupBy("component").count().collect()[0]["count"] == 500


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_rank_in_groups_matches_window(spark):
    random.seed(5)
    rows = [(random.choice("aaab") if i % 7 else None, random.randrange(50), i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, v int, id int")
    got = {(r["id"]): (r["rank"], r["n"]) for r in rank_in_groups(df, ["g"], [F.col("v").desc(), F.col("id")], total="n").collect()}
    want = {}
    for g in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        want |= {r[2]: (k, len(own)) for k, r in enumerate(own, 1)}
    assert got == want


def test_closure_and_cycle(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "whole string, part string")
    assert {tuple(r) for r in closure.closure(e).collect()} == {("a", "b"), ("a", "c"), ("a", "d"), ("b", "c"), ("b", "d"), ("c", "d")}
    with pytest.raises(closure.ContainmentCycle):
        closure.closure(e.unionByName(spark.createDataFrame([("d", "a")], "whole string, part string")))


def _key(spark, f, value):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("k")).first()["k"]


@pytest.mark.parametrize("name", ["Author Alpha, Fixture", "Fixture Author Alpha"])
def test_lead_creator_key(spark, name):
    assert _key(spark, lambda c: K.ascii_key(K.given_first(K.contributors(c)[0])), name) == "fixture author alpha"


def test_contributors(spark):
    assert _key(spark, K.contributors, "Ann X, Bob Y and Cyr Z (eds.)") == ["Ann X", "Bob Y", "Cyr Z"]
    assert _key(spark, K.contributors, "Novák, Jan") == ["Novák, Jan"]
    assert _key(spark, K.contributors, None) == []


def test_ascii_key_and_hint(spark):
    assert _key(spark, K.ascii_key, "  Čeští & Übermut ﬁ ") == "cesti and ubermut fi"
    assert _key(spark, K.title_hint, "Title: A_long_name (copy 2)") == "A long name"


def test_text_cleaning(spark):
    assert _key(spark, T.normal_markdown, "\n\n# A\r\n\x00b\r\n\n") == "# A\nb\n"
    assert _key(spark, T.normal_markdown, "\n ") in ("", " \n")
    assert _key(spark, T.cleaned, "<div>**bold** and _thin_ [link](http://x) <!-- no -->  end .</div>") == "bold and thin link end."
    assert _key(spark, T.corrupted_line, "a prose line with one � sign") is False
    assert _key(spark, T.corrupted_line, "�" * 10 + " ab") is True


def _work(i, **more):
    base = {"id": f"w{i}", "title": f"t{i}", "creator": f"c{i}", "static": 50.0, "priority": 50, "role": 0, "relevance": 70, "must": False, "damage": 0.0, "bytes": 100, "tokens": 100, "cap": None, "bundle": False, "topics": ["x"], "content": [f"w{i}"]}
    return base | more


def test_rarity_and_budget():
    bundle = [_work(i, creator="big", static=97.0 - i + 25 / 10**0.5, bundle=True, topics=["b"]) for i in range(10)]
    single = [_work(20 + i, static=91.0 + 25, topics=[f"s{i}"]) for i in range(2)]
    out = choose(bundle + single, 300, 300, {"b": 2, "s0": 5, "s1": 5})
    chosen = [r[0] for r in out if r[1]]
    assert len(chosen) == 3 and {"w20", "w21"} <= set(chosen)
    assert len(out) == 12 and {r[2] for r in out if not r[1]} == {"capacity"}


def test_must_include_blocks_its_container():
    essay, whole = _work(1, must=True), _work(2, static=200.0, content=["w2", "w1"])
    out = {r[0]: r[2] for r in choose([essay, whole], 2000, 2000)}
    assert out == {"w1": "selected", "w2": "content_overlap:w1"}


def test_packing_keeps_limits_and_evicts_the_lowest():
    units = [{"id": f"w{i}", "unit": 1, "title": f"t{i}", "score": float(i), "priority": 1, "bytes": 60, "tokens": 10} for i in range(5)]
    files, gone = buckets.fill_within(units, 100, 100, 3)
    assert len(files) == 3 and gone == ["w0", "w1"]
    assert all(sum(u["bytes"] for u in f) <= 100 for f in files)


def test_written_tables_are_released_and_need_a_shared_folder(spark):
    import os
    from types import SimpleNamespace

    from bookloom.session import freed, materialize, release, shared_folder

    df = materialize(spark.range(3), "gone")
    path = df._written
    assert os.path.isdir(path.removeprefix("file://"))
    release(df, spark.range(1))
    assert not os.path.isdir(path.removeprefix("file://"))
    with freed():
        path = materialize(spark.range(3), "gone")._written
        assert os.path.isdir(path.removeprefix("file://"))
    assert not os.path.isdir(path.removeprefix("file://"))
    unset = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=unset, sparkContext=SimpleNamespace(master="spark://head:7077", getConf=lambda: unset))
    with pytest.raises(RuntimeError, match="shared|share"):
        shared_folder(cluster)


def test_entry_outlives_a_missing_module(monkeypatch):
    import sys

    import __spark_entry__ as entry

    for name in [m for m in sys.modules if m.startswith("bookloom.llm")]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "xxhash", None)
    names = set(entry.queries())
    assert "usable_documents" in names and not any(n.startswith("p9") for n in names)


@pytest.mark.parametrize("block", [3, 1000])
def test_split_join_is_an_inner_join(spark, block):
    from bookloom.operators.skew import split_join

    random.seed(block)
    rows = [[(random.choice(["a", "a", "a", "b", "c", None]), i) for i in range(40)] for _ in range(2)]
    x, y = (spark.createDataFrame(r, f"k string, {v} int") for r, v in zip(rows, "xy"))
    got = sorted(tuple(r) for r in split_join(x, y, ["k"], block).select("k", "x", "y").collect())
    assert got == sorted((k, i, j) for k, i in rows[0] for m, j in rows[1] if k == m and k is not None)
    assert split_join(x.limit(0), y, ["k"], block).count() == 0
