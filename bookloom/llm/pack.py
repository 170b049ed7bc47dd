"""Filling containers of fixed capacity with whole documents, certified by lower bounds."""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.tokens import with_tokens
from bookloom.session import materialize

#: Documents packed by one task at most, on average.
PART_ITEMS = 20_000
#: Partitions with a gap exchange documents as long as that saves containers, but no more often than this.
ROUNDS = 12


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container of each item: largest first, each into the fullest container it still fits; ties by order."""
    out = np.zeros(len(sizes), dtype=np.int64)
    room: list[tuple[int, int]] = []
    opened = 0
    for i in np.argsort(-sizes, kind="stable"):
        k = bisect_left(room, (int(sizes[i]), -1))
        if k == len(room):
            left, box = capacity, opened
            opened += 1
        else:
            left, box = room.pop(k)
        out[i] = box
        insort(room, (left - int(sizes[i]), box))
    return out


def lower_bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """Containers that any packing needs, by dual feasible functions.

    Besides the sum, for every threshold a up to half the capacity: items above
    ``capacity - a`` count as whole containers, items below a as nothing, the
    others by size (Fekete and Schepers' first function); and for k = 2 to 9 the
    rounding function ``floor((k + 1) x / capacity) / k``, exact multiples kept.
    """
    if not len(sizes):
        return 0
    order = np.argsort(sizes)
    x, n = sizes[order].astype(np.int64), counts[order].astype(np.int64)
    mass, many = np.concatenate(([0], np.cumsum(x * n))), np.concatenate(([0], np.cumsum(n)))
    a = np.concatenate(([0], x, x + 1, capacity - x + 1))
    a = np.unique(a[(a >= 0) & (2 * a <= capacity)])
    low, high = np.searchsorted(x, a, side="left"), np.searchsorted(x, capacity - a, side="right")
    first = (many[-1] - many[high]) + -(-np.maximum(mass[high] - mass[np.minimum(low, high)], 0) // capacity)
    best = max(int(first.max()), -(-int(mass[-1]) // capacity), 1 if many[-1] else 0)
    for k in range(2, 10):
        scaled = (k + 1) * x
        u = np.where(scaled % capacity == 0, x * k / capacity, scaled // capacity)
        best = max(best, int(np.ceil((u * n).sum() / k - 1e-9)))
    return best


def sized_items(docs: DataFrame, limits: DataFrame, profile: str) -> DataFrame:
    """(doc_id, corpus, capacity, piece, pieces, token_start, tokens): documents in tokens, those above the capacity in pieces.

    Only a document above the capacity is cut, into full pieces and a rest.  The
    capacity is that of the corpus and profile, else the largest stated for the
    corpus, else the least of all; a null corpus is the corpus ``null``.  Raises
    where no capacity is stated at all.
    """
    if not limits.where("capacity_tokens > 0").limit(1).count():
        raise ValueError("no capacity is stated")
    wanted = F.max(F.when(F.lower(F.trim("profile")) == profile, F.col("capacity_tokens")))
    caps = limits.where("capacity_tokens > 0").groupBy(F.coalesce(F.trim("corpus"), F.lit("null")).alias("corpus")).agg(F.coalesce(wanted, F.max("capacity_tokens")).alias("capacity"))
    least = limits.where("capacity_tokens > 0").agg(F.min("capacity_tokens").alias("least"))
    sized = with_tokens(docs.select("doc_id", F.coalesce("corpus", F.lit("null")).alias("corpus"), "text"))
    rows = sized.join(caps, "corpus", "left").join(F.broadcast(least)).withColumn("capacity", F.coalesce("capacity", "least"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity"))).cast("int")
    rows = rows.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(1), F.col("pieces"))))
    start = (F.col("piece") - 1) * F.col("capacity")
    return rows.select("doc_id", "corpus", "capacity", "piece", "pieces", start.cast("bigint").alias("token_start"), F.least(F.col("tokens") - start, F.col("capacity")).cast("bigint").alias("size"))


def _packed(items: DataFrame, step: int, parts: DataFrame) -> DataFrame:
    """Items with their box in a partition of step ``step``, and whether the box stays.

    A partition whose containers are as few as its bound keeps all of them; of
    another those with the most room are opened again, as many as make up half
    of it at most.
    """
    spread = F.pmod(F.xxhash64(F.lit(step), "doc_id", "piece", "size"), F.col("parts")).cast("int")
    keyed = items.join(parts, "corpus").withColumn("part", spread).drop("parts")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["doc_id", "piece"], kind="stable")
        sizes, cap = pdf["size"].to_numpy(np.int64), int(pdf["capacity"].iloc[0])
        box = best_fit_decreasing(sizes, cap)
        fill = np.bincount(box, weights=sizes).astype(np.int64)
        bound = lower_bound(*np.unique(sizes, return_counts=True), cap)
        stays = np.ones(len(fill), dtype=bool)
        if len(fill) > bound:
            loosest = np.argsort(fill, kind="stable")
            stays[loosest[: max(2, len(fill) // 2)]] = False
            stays |= fill == cap
        pdf["box"] = [f"{step}-{p}-{b}" for p, b in zip(pdf["part"], box)]
        pdf["stays"] = stays[box]
        return pdf[names]

    schema = "doc_id bigint, corpus string, capacity bigint, piece int, pieces int, token_start bigint, size bigint, box string, stays boolean"
    names = [c.split()[0] for c in schema.split(", ")]
    return keyed.groupBy("corpus", "part").applyInPandas(pack, schema)


def pack(docs: DataFrame, limits: DataFrame, profile: str = "large", part_items: int = PART_ITEMS, rounds: int = ROUNDS) -> DataFrame:
    """(corpus, container, capacity, doc_id, piece, pieces, token_start, tokens) of every document.

    Documents are hashed into partitions of about ``part_items``, each packed by
    best-fit decreasing; partitions that miss their lower bound release their
    loosest containers, whose documents are hashed together anew and packed
    again.  Every document is kept whole unless it exceeds the capacity; empty
    and null texts take no room but have a container.  Extra columns are ignored.
    """
    items = materialize(sized_items(docs, limits, profile), "sizes")
    whole = items.where("size = capacity").select("*", F.concat(F.lit("f-"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("-"), "piece").alias("box"), F.lit(True).alias("stays"))
    done, loose, boxes = whole, items.where("size < capacity"), None
    for step in range(rounds):
        parts = loose.groupBy("corpus").agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / part_items)).cast("int").alias("parts"))
        state = materialize(_packed(loose.select(items.columns), step, parts), "packed")
        used = state.groupBy("corpus", "box").agg(F.max("stays").alias("stays")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("stays")).alias("open")).first()
        if boxes is not None and used["n"] >= boxes:  # the exchange saved nothing
            break
        done, loose, boxes = done.unionByName(state.where("stays")), state.where("NOT stays"), used["open"]
        if not boxes:
            break
    if boxes:
        done = done.unionByName(loose)
    return done.select("corpus", F.concat_ws("-", "corpus", "box").alias("container"), "capacity", "doc_id", "piece", "pieces", "token_start", F.col("size").alias("tokens"))


def certificate(packed: DataFrame, limits: DataFrame) -> DataFrame:
    """(corpus, capacity, containers, bound, tokens, filled, max_files, tooMany): per corpus the containers used and the fewest possible.

    ``tooMany``: there are more containers than the corpus may have files; null
    where no number is stated.
    The bound is computed from the counts of each size, of which there are no
    more than the capacity has tokens.
    """
    sizes = packed.groupBy("corpus", "capacity", F.col("tokens").alias("size")).agg(F.count(F.lit(1)).alias("n"))

    def bound(pdf: pd.DataFrame) -> pd.DataFrame:
        x, n, cap = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), int(pdf["capacity"].iloc[0])
        return pd.DataFrame({"corpus": [pdf["corpus"].iloc[0]], "capacity": [cap], "bound": [max(lower_bound(x, n, cap), 1)], "tokens": [int((x * n).sum())]})

    bounds = sizes.groupBy("corpus").applyInPandas(bound, "corpus string, capacity bigint, bound bigint, tokens bigint")
    used = packed.groupBy("corpus").agg(F.countDistinct("container").alias("containers"))
    files = limits.groupBy(F.coalesce(F.trim("corpus"), F.lit("null")).alias("corpus")).agg(F.max("max_files").alias("max_files"))
    out = bounds.join(used, "corpus").join(files, "corpus", "left")
    return out.select("corpus", "capacity", "containers", "bound", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("filled"), "max_files", (F.col("containers") > F.col("max_files")).alias("tooMany"))
