"""Connected components of records that share keys or name one another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookloom.session import materialize, release

#: A key held by many records is tied in two steps, through this many sub-keys.
SALTS = 64


def star_edges(keyed: DataFrame, node: str = "node", key: str = "key", salts: int = SALTS) -> DataFrame:
    """Edges (a, b), a > b, that tie all nodes of one key through their smallest node.

    Each key is first split into ``salts`` sub-keys, so a key held by a third of
    all rows is never one task's work; the smallest nodes of its sub-keys are
    then tied to the key's own smallest node.  The result is linear in the rows.
    Rows with a null node or key tie nothing; repeated rows change nothing.
    """
    rows = keyed.select(F.col(node).alias("n"), F.col(key).alias("k")).where("n IS NOT NULL AND k IS NOT NULL")
    rows = rows.withColumn("s", F.pmod(F.xxhash64("n"), F.lit(salts)))
    sub = rows.groupBy("k", "s").agg(F.min("n").alias("m"), F.max("n").alias("x"))
    shared = sub.where("m < x").select("k", "s", "m")
    inner = rows.join(shared, ["k", "s"]).where("n > m").select(F.col("n").alias("a"), F.col("m").alias("b"))
    top = sub.groupBy("k").agg(F.min("m").alias("b"), F.max("m").alias("x")).where("b < x").select("k", "b")
    outer = sub.join(top, "k").where("m > b").select(F.col("m").alias("a"), "b")
    return inner.unionByName(outer).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component): every node of an edge with the smallest node it can reach.

    Each round takes the smallest label among a node's neighbours (aggregated
    map-side) and then follows labels once (pointer jumping), so the number of
    rounds grows with the logarithm of the longest path.  Rounds are written to
    the shared folder.  Raises if ``max_rounds`` do not suffice, rather than
    return a partial result.  Null ends are dropped; an empty table gives none.
    """
    pairs = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v")
    both = materialize(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("c")), "labels")
    for _ in range(max_rounds):
        near = both.join(labels.select(F.col("u").alias("v"), F.col("c").alias("d")), "v").groupBy("u").agg(F.min("d").alias("d"))
        moved = labels.join(near, "u").select("u", "c", F.least("c", "d").alias("d"))
        # late in the run most nodes have one label, and only labels that are no root can jump on; roots are left out of the join
        jumps = labels.where("u != c").select(F.col("u").alias("d"), F.col("c").alias("e"))
        new = F.least("d", "e")
        stepped = materialize(moved.where("d != u").join(jumps, "d", "left").select("u", new.alias("c"), (new != F.col("c")).cast("int").alias("changed")).unionByName(moved.where("d = u").select("u", F.col("d").alias("c"), (F.col("d") != F.col("c")).cast("int").alias("changed"))), "labels")
        release(labels)
        labels = stepped
        if not stepped.where("changed = 1").limit(1).count():
            release(both)
            return stepped.select(F.col("u").alias("node"), F.col("c").alias("component"))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def clean_key(column: Column) -> Column:
    """A key trimmed, lower-cased and with inner white space reduced to one space; blank is null."""
    text = F.lower(F.regexp_replace(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " "))
    return F.when(text != "", text)
