"""Packing units into files bounded in bytes and tokens, with eviction down to a number of files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookloom.session import materialize


def fill(units: list[dict], byte_limit: float, token_limit: float) -> list[list[dict]]:
    """Best fit decreasing in two dimensions: the larger share decides the order, the smaller remainder the file."""
    files: list[list] = []
    share = lambda u: max(u["bytes"] / byte_limit, u["tokens"] / token_limit)
    for u in sorted(units, key=lambda u: (-share(u), -u["score"], u["title"], u["id"], u["unit"])):
        best, least = None, None
        for f in files:
            b, t = f[0] - u["bytes"], f[1] - u["tokens"]
            if b >= 0 and t >= 0 and (least is None or max(b / byte_limit, t / token_limit) < least):
                best, least = f, max(b / byte_limit, t / token_limit)
        if best is None:
            best = [byte_limit, token_limit, []]
            files.append(best)
        best[0] -= u["bytes"]
        best[1] -= u["tokens"]
        best[2].append(u)
    return [f[2] for f in files]


def fill_within(units: list[dict], byte_limit: float, token_limit: float, most: int) -> tuple[list[list[dict]], list[str]]:
    """Files, no more than ``most``, and the works evicted for it: the lowest score, priority, and most tokens first."""
    works: dict[str, list] = {}
    for u in units:
        w = works.setdefault(u["id"], [u["score"], u["priority"], 0, u["id"], 0, 0])
        w[2] -= u["tokens"]
        w[4] += min(u["bytes"], byte_limit)
        w[5] += min(u["tokens"], token_limit)
    order = sorted(works.values())
    size, tokens = (sum(w[k] for w in order) for k in (4, 5))
    for k in range(len(order) + 1):
        # what exceeds all files together needs no trial
        if size <= most * byte_limit and tokens <= most * token_limit:
            gone = {w[3] for w in order[:k]}
            files = fill([u for u in units if u["id"] not in gone], byte_limit, token_limit)
            if len(files) <= most:
                break
        size, tokens = size - order[k][4], tokens - order[k][5]
    return files, [w[3] for w in order[:k]]


def pack_files(units: DataFrame, byte_limit: float, token_limit: float, most: int) -> DataFrame:
    """(corpus, id, unit, file, reason): the file of every unit, numbered by its smallest title; null and a reason for evicted works.

    ``units``: corpus, id, unit, title, score, priority, bytes, tokens; no unit
    may exceed a limit.  Works that all files together cannot hold beside those
    evicted after them are evicted beforehand; the units that reach a corpus's
    one Python task are at most what its files hold.
    """
    works, order = Window.partitionBy("corpus", "id"), [F.col("score").desc(), F.col("priority").desc(), F.col("_t"), F.col("id").desc()]
    to_here = Window.partitionBy("corpus").orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(F.least(F.col(c), F.lit(limit))).over(to_here) <= most * limit for c, limit in (("bytes", byte_limit), ("tokens", token_limit))]
    held = materialize(units.withColumn("_t", F.sum("tokens").over(works)).withColumn("_held", sums[0] & sums[1]).drop("_t"), "units")
    early = held.where("NOT _held").select("corpus", "id", F.col("unit").cast("bigint").alias("unit"), F.lit(None).cast("bigint").alias("file"), F.lit("bin_packing_capacity").alias("reason"))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.to_dict("records")
        files, gone = fill_within(rows, byte_limit, token_limit, most)
        files.sort(key=lambda f: min((u["title"], u["id"], u["unit"]) for u in f))
        corpus = pdf["corpus"].iloc[0]
        out = [(corpus, u["id"], u["unit"], k, "packed") for k, f in enumerate(files, 1) for u in f]
        gone = set(gone)
        out += [(corpus, u["id"], u["unit"], None, "bin_packing_capacity") for u in rows if u["id"] in gone]
        frame = pd.DataFrame(out, columns=["corpus", "id", "unit", "file", "reason"])
        frame["file"] = frame["file"].astype("Int64")
        return frame

    packed = held.where("_held").drop("_held").groupBy("corpus").applyInPandas(pack, "corpus string, id string, unit bigint, file bigint, reason string")
    return packed.unionByName(early)
