"""The choice of a portfolio and its files: every work has a row, and none is cut by size."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bookloom.operators import buckets
from bookloom.operators.select import choose, select_portfolio
from bookloom.plans import portfolio

DATA = Path("/root/testdata/sf0.001")
_WORK = "corpus string, id string, title string, creator string, static double, priority int, role int, relevance int, must boolean, damage double, bytes bigint, tokens bigint, cap double, bundle boolean, topics array<string>, content array<string>"


def _works(seed, n, corpus):
    r = random.Random(seed)
    for i in range(n):
        held = [f"w{r.randrange(n):03d}" for _ in range(r.choice([0, 0, 0, 1, 2]))]
        size = r.choice([1, 5, 20, 60])
        yield (corpus, f"w{i:03d}", f"t{r.randrange(9)}", f"c{r.randrange(12)}", float(r.randrange(-10, 90)), r.randrange(5), r.randrange(3), 70, r.random() < 0.15, 0.0, size * 4, size, r.choice([None, 1.0, 2.0]), r.random() < 0.2, r.sample("abcdefgh", r.randrange(4)), list(dict.fromkeys([f"w{i:03d}", *held])))


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_portfolio_of_any_frontier_is_the_plain_choice(spark, most):
    rows = [*_works(1, 90, "x"), *_works(2, 60, "y")]
    columns = [c.split()[0] for c in _WORK.split(", ")]
    got = {(r["corpus"], r["id"]): (r["place"], r["reason"], round(r["score"], 6)) for r in select_portfolio(spark.createDataFrame(rows, _WORK), 3000, 700, {"a": 2.0}, most=most).collect()}
    want = {}
    for corpus in "xy":
        own = [dict(zip(columns, r)) for r in rows if r[0] == corpus]
        want |= {(corpus, i): (place, reason, round(score, 6)) for i, place, reason, score in choose(own, 3000, 700, {"a": 2.0})}
    assert got == want
    assert len({r[1].split(":")[0] for r in got.values()}) >= 4


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_every_work_of_a_large_corpus_has_a_row(spark, tmp_path):
    rows = spark.read.parquet(str(DATA / "curated_works.parquet"))
    times = 12_000 // rows.select("id").distinct().count() + 1
    many = rows.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(times)))).withColumn("id", F.concat_ws("-", "id", "n")).drop("n")
    many.write.parquet(str(tmp_path / "curated_works.parquet"))
    (tmp_path / "book_units.parquet").symlink_to(DATA / "book_units.parquet")  # holds the damage of works
    out = entry.queries()["portfolio_select"](spark, str(tmp_path)).select("id", "reason").collect()
    assert len(out) == len({r["id"] for r in out}) == many.select("id").distinct().count() > 10_000
    assert all(r["reason"] for r in out)


def _plain(units, byte_limit, token_limit, most):
    gone = set()
    while len(buckets.fill(left := [u for u in units if u["id"] not in gone], byte_limit, token_limit)) > most:
        gone.add(min((u["score"], u["priority"], -sum(x["tokens"] for x in left if x["id"] == u["id"]), u["id"]) for u in left)[3])
    return gone


def test_eviction_is_by_score_priority_and_tokens(spark):
    r = random.Random(7)
    works = {(c, f"w{i:02d}"): (float(r.randrange(4)), r.randrange(3)) for c in "xy" for i in range(40)}
    units = [{"corpus": c, "id": i, "unit": k, "title": f"t {i}", "score": s, "priority": p, "bytes": (b := r.randrange(5, 60)), "tokens": b // 2 + r.randrange(9)} for (c, i), (s, p) in works.items() for k in range(1, r.randrange(2, 4))]
    columns = "corpus string, id string, unit bigint, title string, score double, priority int, bytes int, tokens bigint"
    rows = buckets.pack_files(spark.createDataFrame([tuple(u.values()) for u in units], columns), 100, 60, 7).collect()
    assert sorted((x["corpus"], x["id"], x["unit"]) for x in rows) == sorted((u["corpus"], u["id"], u["unit"]) for u in units)
    for c in "xy":
        own = [u for u in units if u["corpus"] == c]
        assert {x["id"] for x in rows if x["corpus"] == c and x["reason"] == "bin_packing_capacity"} == _plain(own, 100, 60, 7)
        assert {x["file"] for x in rows if x["corpus"] == c} - {None} == set(range(1, 8))


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_file_packing_has_the_files_real_capacity(spark, tmp_path):
    spark.read.parquet(str(DATA / "curated_works.parquet")).write.parquet(str(tmp_path / "curated_works.parquet"))
    units = spark.read.parquet(str(DATA / "book_units.parquet"))
    many = units.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(200)))).withColumn("workId", F.concat_ws("-", "workId", "n")).drop("n")
    many.write.parquet(str(tmp_path / "book_units.parquet"))
    assert {r["reason"] for r in entry.queries()["file_packing"](spark, str(tmp_path)).select("reason").distinct().collect()} == {"packed"}


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_file_packing_evicts_the_lowest_scores(spark, monkeypatch):
    score = {r["id"]: r["score"] for r in portfolio.portfolio_select(spark, str(DATA)).collect()}
    monkeypatch.setattr(portfolio, "FILE_BYTES", 9_000)
    monkeypatch.setattr(portfolio, "FILES", 1)
    rows = portfolio.file_packing(spark, str(DATA)).collect()
    assert {r["reason"] for r in rows} == {"packed", "bin_packing_capacity"}
    for corpus in {r["corpus"] for r in rows}:
        kept, gone = ([score.get(r["id"], 0.0) for r in rows if r["corpus"] == corpus and (r["file"] is not None) == x] for x in (True, False))
        assert not kept or not gone or max(gone) <= min(kept)
