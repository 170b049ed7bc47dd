"""Capping records per dominant contributor, stratum by stratum."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookloom.operators.graph import clean_key
from bookloom.operators.ranking import rank_in_groups
from bookloom.session import materialize


def latest_rows(df: DataFrame, key: list[str], order: list[str], keep: list[str]) -> DataFrame:
    """One row per ``key``: the one greatest in ``order``, then in ``keep`` (nulls lowest)."""
    newest = F.max(F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)], *[F.col(c) for c in keep])).alias("r")
    return df.groupBy(*key).agg(newest).select(*key, *[F.col(f"r.{c}").alias(c) for c in keep])


def apportion(cap: int, sizes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Split ``cap`` slots over strata by largest remainder, never above a stratum's size.

    Slots that a small stratum cannot fill are apportioned again among the
    others by the same weights until none is left or all strata are full.
    Ties of remainders go to the earlier stratum.
    """
    slots = np.zeros(len(sizes), dtype=np.int64)
    spare = int(min(max(cap, 0), sizes.sum()))
    while spare > 0:
        room = sizes - slots
        w = np.where(room > 0, weights, 0.0)
        if w.sum() <= 0:
            w = (room > 0).astype(float)
        quota = spare * w / w.sum()
        give = np.floor(quota).astype(np.int64)
        rest = np.argsort(-(quota - give) - (room > 0) * 1e-12, kind="stable")
        for i in rest[: spare - int(give.sum())]:
            give[i] += 1
        give = np.minimum(give, room)
        slots += give
        spare -= int(give.sum())
    return slots


def share_caps(sizes: DataFrame, scope: list[str], share: float) -> DataFrame:
    """(*scope, most): the largest cap at which no contributor has more than ``share`` of what is kept in its scope.

    ``sizes`` holds scope columns and ``n``, the rows of one contributor.  Where
    no cap meets the share, as with few contributors, the cap is 1.  Only the
    different sizes, at most the root of twice the rows, are sorted by scope.
    """
    kinds = sizes.groupBy(*scope, "n").agg(F.count(F.lit(1)).alias("m"))
    upto = Window.partitionBy(*scope).orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*scope).orderBy("n").rowsBetween(1, Window.unboundedFollowing)
    kinds = kinds.withColumns({"below": F.sum(F.col("n") * F.col("m")).over(upto), "above": F.coalesce(F.sum("m").over(after), F.lit(0)), "next": F.lead("n").over(Window.partitionBy(*scope).orderBy("n"))})
    # between two sizes the kept rows are below + cap * above; 0 < cap below the least size keeps cap of each
    least = kinds.groupBy(*scope).agg(F.sum("m").alias("above"), F.min("n").alias("next")).withColumns({"n": F.lit(1).cast("bigint"), "below": F.lit(0).cast("bigint")})
    pieces = kinds.drop("m").unionByName(least)
    rest = 1 - share * F.col("above")
    top = F.when(rest > 0, F.floor(share * F.col("below") / rest + 1e-9)).otherwise(F.coalesce("next", "n"))
    top = F.least(top, F.coalesce("next", top))
    return pieces.groupBy(*scope).agg(F.coalesce(F.max(F.when(top >= F.col("n"), top)), F.lit(1)).cast("bigint").alias("most"))


def cap_contributors(rows: DataFrame, group: list[str], cap: str, stratum: Column, order: list[Column], exponent: float | None = 0.5, share: float | None = None) -> DataFrame:
    """``rows`` with columns ``stratum``, ``slots``, ``place`` and ``kept``.

    A group's cap is the largest ``cap`` on its rows; a group without one, or
    with a null in any group column, keeps everything, and has null ``place``
    and ``slots`` like every group that its cap does not bind.  With ``share``
    no group keeps more than the cap of :func:`share_caps`, the scope being all
    group columns but the last.  The cap is split over the group's strata by
    largest remainder, spare slots are redistributed, and inside a stratum rows
    are kept in ``order``, which must be total.  Strata weigh ``size ** exponent``
    (1: as the rows are spread, 0: evenly), or, with no exponent, by merit: the
    number of their rows among the group's first.  A cap of 0 or less keeps
    nothing.  Only counts per stratum reach Python, and only of groups whose cap
    binds; a stratum column has few values.  Rows are placed by a range
    partition, so a group of any size is spread over tasks.  Empty in, empty out.
    """
    known = None
    for c in group:
        known = F.col(c).isNotNull() if known is None else known & F.col(c).isNotNull()
    rows = rows.withColumn("stratum", F.coalesce(stratum.cast("string"), F.lit("")))
    totals = rows.where(known).groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.max(cap).cast("bigint").alias("most"))
    if share is not None:
        bound = share_caps(totals.select(*group[:-1], "n"), group[:-1], share).withColumnRenamed("most", "_share")
        totals = totals.join(bound, group[:-1]) if group[:-1] else totals.crossJoin(F.broadcast(bound))
        totals = totals.withColumn("most", F.least("most", "_share"))
    over = materialize(totals.where("most < n").select(*group, F.greatest("most", F.lit(0)).alias("most")), "over")
    bound_rows = rows.join(over, group).select(*rows.columns, "most")
    placed = materialize(rank_in_groups(bound_rows, group, order, out="merit", inner={"place": ["stratum"]}), "placed")
    sizes = placed.groupBy(*group, "stratum").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("merit") <= F.col("most")).alias("first"), F.max("most").alias("most"))
    parts = sizes.groupBy(*group).agg(F.max("most").alias("most"), F.sort_array(F.collect_list(F.struct("stratum", "n", "first"))).alias("parts"))

    @F.pandas_udf("array<bigint>")
    def apportioned(most: pd.Series, counts: pd.Series, firsts: pd.Series) -> pd.Series:
        weights = firsts if exponent is None else [np.asarray(n, dtype=float) ** exponent for n in counts]
        return pd.Series([apportion(int(m), np.asarray(n, dtype=np.int64), np.asarray(w, dtype=float)).tolist() for m, n, w in zip(most, counts, weights)])

    slots = parts.withColumn("slots", apportioned("most", "parts.n", "parts.first")).select(*group, F.inline(F.arrays_zip(F.col("parts.stratum").alias("stratum"), F.col("slots").alias("slots"))))
    capped = placed.join(slots, [*group, "stratum"]).withColumn("kept", F.col("place") <= F.col("slots")).withColumn("place", F.col("place").cast("bigint"))
    nothing = F.lit(None).cast("bigint")
    free = rows.where(~known).unionByName(rows.where(known).join(over, group, "left_anti")).withColumns({"slots": nothing, "place": nothing, "kept": F.lit(True)})
    return capped.select(free.columns).unionByName(free)


def counted_decisions(curated: DataFrame) -> DataFrame:
    """One row per run and work (the latest ``decidedAt``), with the creator's key made even."""
    keep = ["loadedAt", "corpus", "creatorKey", "priorityScore", "authorSoftMaximum", "contentType", "decidedAt"]
    rows = latest_rows(curated, ["runId", "id"], ["decidedAt"], keep)
    return rows.withColumn("creator", clean_key(F.col("creatorKey")))


def cap_decisions(curated: DataFrame, exponent: float | None = None) -> DataFrame:
    """The decisions of ``curated_works`` with the cap of each run, corpus and creator applied, split over content types.

    Without an exponent the content types weigh by merit, so that a creator's
    best decisions stay, by priorityScore descending (nulls last), then id.
    """
    order = [F.col("priorityScore").desc_nulls_last(), F.col("id").asc()]
    return cap_contributors(counted_decisions(curated), ["runId", "corpus", "creator"], "authorSoftMaximum", F.coalesce(F.col("contentType"), F.lit("none")), order, exponent)
