"""Ranks inside groups of any size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookloom.session import materialize


def rank_in_groups(df: DataFrame, group: list[str], order: list[Column], out: str = "rank", total: str | None = None, inner: dict[str, list[str]] | None = None) -> DataFrame:
    """``df`` with each row's 1-based place in its group, without giving a group to one task.

    Rows are range-partitioned by group and order, so a hot group spreads over
    many partitions and keeps its order; a place is the place inside the
    partition plus the group's rows in earlier partitions, which is a table of
    at most one row per group and partition.  ``order`` must be total for the
    result to be unique; with ties any order of the tied rows may come out.
    ``total`` names a column for the group's size; ``inner`` names further
    columns for the place among those rows of the group that also agree in some
    columns.  Empty in, empty out.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    parts = df.repartitionByRange(n, *[F.col(c) for c in group], *order).withColumn("_part", F.spark_partition_id())
    rows = materialize(parts, "ranged")
    made = rows
    for name, more in {out: [], **(inner or {})}.items():
        keys = [*group, *more]
        counts = rows.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
        counts = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_n"))
        if total and name == out:
            counts = counts.withColumn(total, F.sum("_n").over(Window.partitionBy(*keys)))
        counts = counts.withColumnsRenamed({c: f"_k_{c}" for c in ["_part", *keys]}).drop("_n")
        on = reduce(lambda x, y: x & y, (F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in keys), F.col("_part") == F.col("_k__part"))
        placed = made.withColumn(name, F.row_number().over(Window.partitionBy("_part", *keys).orderBy(*order)))
        made = placed.join(counts, on).withColumn(name, F.col(name) + F.col("_before")).drop("_before", *[f"_k_{c}" for c in ["_part", *keys]])
    return made.drop("_part")


def running_sums(df: DataFrame, group: list[str], order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with, for each name in ``sums``, the sum of its column over the group's rows up to and with each row.

    Like :func:`rank_in_groups` rows are range-partitioned, so no group is one
    task's work.  ``order`` must be total and group columns not null.
    """
    n = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = df.withColumns({f"_{name}": column for name, column in sums.items()})
    rows = materialize(own.repartitionByRange(n, *[F.col(c) for c in group], *order).withColumn("_part", F.spark_partition_id()), "ranged")
    within = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    parts = rows.groupBy("_part", *group).agg(*[F.sum(f"_{name}").alias(f"_s_{name}") for name in sums])
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", *group, *[F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0)).alias(f"_b_{name}") for name in sums])
    out = rows.withColumns({name: F.sum(f"_{name}").over(within) for name in sums}).join(parts, ["_part", *group])
    return out.select(*df.columns, *[(F.col(name) + F.col(f"_b_{name}")).alias(name) for name in sums])
