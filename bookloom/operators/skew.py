"""Joins in which no task pairs more rows of one key than a block of each side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.session import materialize, release

#: Rows of one key on one side that a task gets at most, on average.
BLOCK = 10_000
#: Hot keys that are sent to all executors at most; more are joined.
SENT = 100_000


def split_join(left: DataFrame, right: DataFrame, on: list[str], block: int = BLOCK) -> DataFrame:
    """The inner join of two tables on columns of equal names, whatever the rows of one key.

    Keys of more than ``block`` rows on a side are counted first, of which there
    are at most as many as the rows divided by ``block``.  The rows of such a key
    are cut into blocks by hash, and each block of the one side meets each block
    of the other in a task of its own; rows of other keys are not repeated.  Null
    keys match nothing.
    """
    sides = {"_l": left, "_r": right}
    counts = [d.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block).select(*on, F.ceil(F.col("_n") / block).alias(f"{s}n"), F.lit(1).alias(f"{t}n")) for (s, d), t in zip(sides.items(), ("_r", "_l"))]
    hot = materialize(counts[0].unionByName(counts[1]).groupBy(*on).agg(F.max("_ln").alias("_ln"), F.max("_rn").alias("_rn")), "hot")
    many = hot.count()
    if not many:
        release(hot)
        return left.join(right, on)
    known = F.broadcast(hot) if many <= SENT else hot
    parts = []
    for (own, d), other in zip(sides.items(), ("_r", "_l")):
        rows = d.join(known, on, "left").withColumn(f"{own}k", F.pmod(F.xxhash64(*d.columns), F.coalesce(f"{own}n", F.lit(1))).cast("int"))
        parts.append(rows.withColumn(f"{other}k", F.explode(F.sequence(F.lit(0), (F.coalesce(f"{other}n", F.lit(1)) - 1).cast("int")))).drop("_ln", "_rn"))
    return parts[0].join(parts[1], [*on, "_lk", "_rk"]).drop("_lk", "_rk")
