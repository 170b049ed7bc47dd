"""Ids of candidates kept from an earlier snapshot."""

import random
from datetime import datetime

import __spark_entry__ as entry
from bookloom.operators.matching import assign_once


def test_assign_once_is_taking_in_turn(spark):
    r = random.Random(4)
    pairs = {(f"c{r.randrange(40):02d}", f"p{r.randrange(25):02d}"): r.randrange(1, 4) for _ in range(200)}
    place = {c: k for k, c in enumerate(r.sample(sorted({c for c, _ in pairs}), len({c for c, _ in pairs})))}
    got = {tuple(x) for x in assign_once(spark.createDataFrame([(c, p, w, place[c]) for (c, p), w in pairs.items()], "c string, p string, w int, place int"), "c", "p", "w", "place").collect()}
    want, used = set(), set()
    for c in sorted(place, key=place.get):
        if own := sorted((-w, p) for (x, p), w in pairs.items() if x == c and p not in used):
            want.add((c, own[0][1], -own[0][0]))
            used.add(own[0][1])
    assert got == want


def test_split_and_merged_candidates_keep_each_id_once(spark, tmp_path):
    old, new = datetime(2024, 3, 1), datetime(2025, 3, 1)
    scans = [("f1", "a", old, "A"), ("f2", "b", old, "A"), ("f3", "c", old, "A"), ("f4", "d", old, "B")]
    scans += [("f1", "a", new, "one"), ("f2", "b", new, "two"), ("f3", "c", new, "two"), ("f4", "d", new, "two"), ("f5", "e", new, "three"), ("f6", "f", new, "A")]
    rows = [(i, path, ".md", 1, f"sha {i} {key}", key, None, None, at) for i, path, at, key in scans]
    columns = "id string, relativePath string, extension string, size bigint, sha256 string, workHintKey string, metadata struct<title: string>, hints struct<title: string>, scannedAt timestamp"
    spark.createDataFrame(rows, columns).write.parquet(str(tmp_path / "inventory_files.parquet"))
    got = {tuple(r) for r in entry.queries()["previous_ids"](spark, str(tmp_path)).select("candidate", "previous", "files").collect()}
    # A is split: its first part keeps f1, the larger falls back to the id it merged in
    assert got == {("f1", "f1", 1), ("f2", "f4", 1), ("f5", None, 0), ("f6", None, 0)}
