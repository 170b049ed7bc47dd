"""Containment: closure of whole-and-part relations, cycles, and what containers inherit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.session import materialize, release


class ContainmentCycle(ValueError):
    """A work contains itself, directly or through others."""


def relations(works: DataFrame) -> DataFrame:
    """(whole, part) of works that exist, from ``containsWorkIds`` and ``containedByWorkIds``; self-relations dropped.

    Null or empty arrays state nothing; repeated relations count once.
    """
    down = works.select(F.col("id").alias("whole"), F.explode("containsWorkIds").alias("part"))
    up = works.select(F.explode("containedByWorkIds").alias("whole"), F.col("id").alias("part"))
    ids = works.select("id").distinct()
    edges = down.unionByName(up).where("whole != part").distinct()
    return edges.join(ids.withColumnRenamed("id", "whole"), "whole", "left_semi").join(ids.withColumnRenamed("id", "part"), "part", "left_semi").select("whole", "part")


def closure(edges: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(whole, part) for every direct or indirect relation.

    Paths double in every round, so n levels take log n rounds.  A cycle shows
    as a work within itself and raises :class:`ContainmentCycle`.
    """
    paths = materialize(edges.select("whole", "part").distinct(), "paths")
    size = paths.count()
    for _ in range(max_rounds):
        loop = paths.where("whole = part").limit(1).collect()
        if loop:
            raise ContainmentCycle(f"containment cycle at {loop[0]['whole']}")
        step = paths.select("whole", F.col("part").alias("mid")).join(paths.select(F.col("whole").alias("mid"), "part"), "mid").select("whole", "part")
        longer = materialize(paths.unionByName(step).distinct(), "paths")
        grown = longer.count()
        release(paths)
        if grown == size:
            return longer
        paths, size = longer, grown
    raise RuntimeError(f"closure did not settle in {max_rounds} rounds")


def inherited_topics(works: DataFrame, paths: DataFrame) -> DataFrame:
    """(id, topic): a work's own topics and those of all it contains."""
    own = works.select("id", F.explode("topicKeys").alias("topic"))
    below = paths.join(own.withColumnRenamed("id", "part"), "part").select(F.col("whole").alias("id"), "topic")
    return own.unionByName(below).distinct()
