"""Giving each thing to one taker, as if the takers came one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.session import materialize, release


def assign_once(pairs: DataFrame, taker: str, item: str, weight: str, place: str) -> DataFrame:
    """(taker, item, weight): what each taker gets if they come in the order of ``place`` and take the item of greatest weight, then smallest name, of those left.

    Computed without going through the takers: all ask for their best item at
    once, each item keeps the first of those that ask, and no taker after that
    one can get it; the pairs so excluded are dropped, until none is.  ``place``
    is unique by taker.
    """
    left = materialize(pairs.select(taker, item, weight, place), "pairs")
    while True:
        asked = left.groupBy(taker).agg(F.min(F.struct((-F.col(weight)).alias("w"), F.col(item).alias("i"), F.col(place).alias("p"))).alias("b"))
        held = materialize(asked.groupBy(F.col("b.i").alias(item)).agg(F.min(F.struct(F.col("b.p").alias("p"), F.col(taker).alias("t"), (-F.col("b.w")).alias("w"))).alias("h")), "held")
        rest = left.join(held, item, "left").where(F.col("h").isNull() | (F.col(place) <= F.col("h.p"))).select(left.columns)
        rest, n = materialize(rest, "pairs"), left.count()
        if rest.count() == n:
            return held.select(F.col("h.t").alias(taker), item, F.col("h.w").alias(weight))
        release(left, held)
        left = rest
