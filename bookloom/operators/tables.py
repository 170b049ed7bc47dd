"""Joins and unions that check what they lose."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.operators.ranking import running_sums


class Unmatched(ValueError):
    """Rows that should have a partner and have none."""


def matched(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """``left`` joined to ``right``; raises :class:`Unmatched` where a row of ``left`` has no partner."""
    lost = left.join(right.select(*on).distinct(), on, "left_anti").select(*on).limit(5).collect()
    if lost:
        raise Unmatched("; ".join(" | ".join(str(v) for v in r) for r in lost))
    return left.join(right, on)


def all_matched(wanted: DataFrame, there: DataFrame, on: list[str]) -> DataFrame | None:
    """The rows of ``there`` that are wanted, or nothing unless every wanted row is there."""
    keys = wanted.select(*on).distinct()
    if keys.join(there.select(*on).distinct(), on, "left_anti").limit(1).count():
        return None
    return there.join(keys, on, "left_semi")


def later_wins(sources: list[DataFrame], key: list[str]) -> DataFrame:
    """All rows of tables of one shape, of each key those of the last table that has it; of several there the greatest."""
    columns = sources[0].columns
    rest = [c for c in columns if c not in key]
    rows = reduce(DataFrame.unionByName, (d.select(*columns).withColumn("_from", F.lit(k)) for k, d in enumerate(sources)))
    best = rows.groupBy(*key).agg(F.max(F.struct("_from", *rest)).alias("_r"))
    return best.select(*[F.col(c) if c in key else F.col(f"_r.{c}").alias(c) for c in columns])


def replace_part(old: DataFrame, new: DataFrame, column: str, values: list[str]) -> DataFrame:
    """``old`` with its rows of some values of ``column`` replaced by those of ``new``; null belongs to no value."""
    ours = F.coalesce(F.col(column).isin(values), F.lit(False))
    return old.where(~ours).unionByName(new.where(ours), allowMissingColumns=True)


def pending(works: DataFrame, decided: DataFrame, on: list[str]) -> DataFrame:
    """Works without a decision made on the same input: ``on`` names the id and whatever a decision depends on (null-safe)."""
    keys = decided.select(*[F.col(c).alias(f"_{c}") for c in on]).distinct()
    return works.join(keys, reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in on)), "left_anti")


def reusable(now: DataFrame, before: DataFrame, key: list[str], same: list[str], times: list[str], tolerance: float = 1.0) -> DataFrame:
    """``now`` with ``reuse``: an earlier row of the key agrees in ``same`` (null-safe) and, to less than ``tolerance``, in ``times``, and did not fail."""
    names = [*same, *times]
    old = before.where("NOT coalesce(failed, false) AND NOT coalesce(skipped, false)").select(*key, *[F.col(c).alias(f"_{c}") for c in names])
    agrees = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same] + [F.abs(F.col(c) - F.col(f"_{c}")) < tolerance for c in times])
    good = now.join(old, key).where(agrees).select(*key).distinct().withColumn("reuse", F.lit(True))
    return now.join(good, key, "left").withColumn("reuse", F.coalesce("reuse", F.lit(False)))


def within_budget(batches: DataFrame, order: list[Column], size: str, budget: int) -> DataFrame:
    """The first batches in order whose sizes together stay within a budget.  ``order`` must be total."""
    return running_sums(batches, [], order, {"_upto": F.coalesce(F.col(size), F.lit(0))}).where(F.col("_upto") <= budget).drop("_upto")


def progress(done: Column, total: Column, elapsed: Column) -> Column:
    """struct<percent, remaining>: what part is done, and the time left at the pace so far; null before anything is done."""
    part = F.when(total > 0, done / total)
    return F.struct(F.round(100 * part, 1).alias("percent"), F.when(done > 0, elapsed / done * F.greatest(total - done, F.lit(0))).alias("remaining"))
