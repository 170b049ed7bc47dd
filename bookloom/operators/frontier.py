"""Which works of a corpus are worth the cost of conversion: what must be, alternatives of a whole, the greedy choice, the ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.operators.ranking import rank_in_groups
from bookloom.operators.select import select_portfolio
from bookloom.session import materialize

#: A whole that is at most this many times as large as the smallest whole is an alternative too.
NEARLY = 1.05


def containment_alternatives(works: DataFrame, paths: DataFrame) -> DataFrame:
    """(id): parts worth having alone beside the smallest wholes that hold them.

    A part counts that is of high value alone, has no required whole and is
    smaller than each of them; with it count its wholes of nearly the smallest
    size.  ``works``: id, must, standalone, size; ``paths``: whole, part.
    """
    sized = works.select("id", "must", "standalone", F.greatest(F.coalesce("size", F.lit(1)), F.lit(1)).alias("size"))
    whole = sized.select(F.col("id").alias("whole"), F.col("must").alias("wholeMust"), F.col("size").alias("wholeSize"))
    pairs = paths.join(whole, "whole").join(sized.withColumnRenamed("id", "part"), "part").where("standalone = 'high'")
    least = pairs.groupBy("part").agg(F.min("wholeSize").alias("least"), F.max(F.coalesce("wholeMust", F.lit(False))).alias("required"), F.first("size").alias("own"))
    apart = materialize(least.where("NOT required AND own < least").select("part", "least"), "apart")
    beside = pairs.join(apart, "part").where(F.col("wholeSize") <= F.col("least") * NEARLY).select(F.col("whole").alias("id"))
    return apart.select(F.col("part").alias("id")).unionByName(beside).distinct()


def conversion_frontier(works: DataFrame, paths: DataFrame, most: int, known: DataFrame | None = None, previous: DataFrame | None = None) -> DataFrame:
    """(corpus, id, rank, selected, reason) of every work.

    ``works`` are those of :func:`select_portfolio` with ``standalone``.
    Required are works that must be included, those of ``previous`` (id), the
    last choice, and those not in ``known`` (id), the works of the last plan;
    without one none is new.  Room for ``most`` works of a corpus, or all that
    are required if those are more, is filled with the required, containment
    alternatives, the greedy choice by number of works, and the static ranking,
    in this order.  A work's reason is the first that holds of: must be
    included, new, chosen before, alternative, frontier.
    """
    ids = works.select("id")
    marks = works.withColumn("size", F.col("tokens"))
    alternatives = containment_alternatives(marks, paths).withColumn("alternative", F.lit(True))
    unit = works.drop("standalone").withColumns({"bytes": F.lit(1).cast("bigint"), "tokens": F.lit(1).cast("bigint")})
    picked = select_portfolio(unit, max(1, most), max(1, most), least=float("-inf")).select("id", F.col("place").cast("bigint").alias("pick"))
    new = (ids.join(known.select("id").distinct(), "id", "left_anti") if known is not None else ids.limit(0)).withColumn("new", F.lit(True))
    before = (previous.select("id").distinct().join(ids, "id", "left_semi") if previous is not None else ids.limit(0)).withColumn("before", F.lit(True))
    rows = works.select("corpus", "id", F.coalesce("must", F.lit(False)).alias("must"), "static", "priority", "tokens", "title")
    for more in (alternatives, picked, new, before):
        rows = rows.join(more, "id", "left")
    rows = rows.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("alternative", "new", "before")})
    required = F.col("must") | F.col("new") | F.col("before")
    rows = materialize(rows.withColumn("class", F.when(required, 0).when(F.col("alternative"), 1).when(F.col("pick").isNotNull(), 2).otherwise(3)), "frontier")
    # the greedy choice keeps its own order, all else that of the static ranking
    order = [F.col("class"), F.when(F.col("class") == 2, F.col("pick")).otherwise(0), F.col("static").desc(), F.col("priority").desc(), F.col("tokens"), F.col("title"), F.col("id")]
    ranked = rank_in_groups(rows, ["corpus"], order)
    room = rows.groupBy("corpus").agg(F.greatest(F.lit(most), F.count_if(F.col("class") == 0)).alias("room"))
    out = ranked.join(room, "corpus").withColumn("selected", F.col("rank") <= F.col("room"))
    reason = F.when(F.col("must"), "must_include").when(F.col("new"), "newly_added_work").when(F.col("before"), "previous_final_selection").when(F.col("alternative"), "containment_alternative").otherwise("curation_frontier")
    return out.select("corpus", "id", "rank", "selected", F.when(F.col("selected"), reason).otherwise("preconversion_marginal_value").alias("reason"))
