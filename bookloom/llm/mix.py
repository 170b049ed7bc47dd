"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookloom.llm.tokens import with_tokens
from bookloom.operators.graph import clean_key
from bookloom.operators.ranking import running_sums
from bookloom.session import materialize

#: Tokens of a block, on average.
BLOCK_TOKENS = 4096
#: Tokens of an output shard.
SHARD_TOKENS = 1_000_000
SEED = 11


#: From this many blocks on a hypergeometric draw is made by its normal limit.
LARGE = 10**9


def drawn(rng: np.random.Generator, quotas: np.ndarray, take: int) -> np.ndarray:
    """A multivariate-hypergeometric draw of ``take`` blocks from ``quotas``, source after source."""
    out, left, rest = np.zeros(len(quotas), dtype=np.int64), int(take), int(quotas.sum())
    for i, own in enumerate(int(q) for q in quotas):
        others = rest - own
        if rest < LARGE:
            x = int(rng.hypergeometric(own, others, left)) if own and left else 0
        else:
            mean = left * own / rest
            spread = (mean * (others / rest) * ((rest - left) / (rest - 1))) ** 0.5
            x = min(max(round(rng.normal(mean, spread)), left - others, 0), own, left)
        out[i], left, rest = x, left - x, others
    return out


def shard_quotas(quotas: np.ndarray, shards: int, shard: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The blocks of each source that fall to one of ``shards`` shards, and those that fall to shards before it.

    The quotas are split from the root down: each node hands half of its shards
    a multivariate-hypergeometric draw of its blocks, seeded by the node, so all
    shards agree without seeing one another and together use every quota exactly.
    """
    q, lo, hi = np.asarray(quotas, dtype=np.int64), 0, shards
    before = np.zeros(len(q), dtype=np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = drawn(np.random.default_rng([seed, lo, hi]), q, int(q.sum()) * (mid - lo) // (hi - lo))
        if shard < mid:
            q, hi = left, mid
        else:
            q, before, lo = q - left, before + left, mid
    return q, before


def clean_targets(targets: DataFrame) -> DataFrame:
    """(source, target, repeats): one row per source after trimming and lower-casing.

    The largest stated share and the least stated number of repeats count; no
    stated number allows one use.  Shares that are null, not a number or not
    positive ask for nothing.
    """
    share = F.when((F.col("target_share") > 0) & ~F.isnan("target_share"), F.col("target_share"))
    return (
        targets.select(clean_key(F.col("source")).alias("source"), share.alias("s"), F.when(F.col("max_repeats") > 0, F.col("max_repeats")).alias("r"))
        .where("source IS NOT NULL")
        .groupBy("source")
        .agg(F.coalesce(F.max("s"), F.lit(0.0)).alias("target"), F.coalesce(F.min("r"), F.lit(1)).cast("int").alias("repeats"))
    )


class Mix:
    """A mix of ``docs`` (doc_id, source, text) to ``targets``, as large as the scarcest source allows.

    The total is the greatest at which every source that has documents gives its
    share without more than its allowed repeats, so no share is traded for size.
    A source's documents fall into blocks; blocks are taken in the order of a
    permutation of each repeat, and of the block in which the quota ends only as
    many documents are taken as come nearest to it.  Sources without documents
    are reported with nothing reached; documents of sources without a target,
    and of null source, are left out and reported under their source.
    """

    def __init__(self, docs: DataFrame, targets: DataFrame, block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS, seed: int = SEED) -> None:
        source = F.coalesce(clean_key(F.col("source")), F.lit(""))
        sized = materialize(with_tokens(docs.select("doc_id", source.alias("source"), "text")), "sizes")
        have = sized.groupBy("source").agg(F.sum("tokens").alias("available"))
        plan = clean_targets(targets).join(have, "source", "full").select("source", F.coalesce("target", F.lit(0.0)).alias("target"), F.coalesce("repeats", F.lit(0)).alias("repeats"), F.coalesce("available", F.lit(0)).alias("available"))
        live = (F.col("target") > 0) & (F.col("available") > 0)
        sums = plan.agg(F.sum(F.when(live, F.col("target"))).alias("shares"))
        plan = plan.join(F.broadcast(sums)).withColumn("share", F.when(live, F.col("target") / F.col("shares")).otherwise(0.0))
        scarce = plan.where(live).agg(F.min(F.col("repeats") * F.col("available") / F.col("share")).alias("total"))
        plan = plan.join(F.broadcast(scarce)).withColumn("quota", F.coalesce(F.floor(F.col("total") * F.col("share")), F.lit(0)))
        plan = plan.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("available") / block_tokens)).cast("bigint"))
        #: (source, target, repeats, available, share, quota, blocks)
        self.plan = materialize(plan.select("source", "target", "repeats", "available", "share", "quota", "blocks"), "plan")
        used = self.plan.where("quota > 0").select("source", "repeats", "quota", "blocks")
        placed = sized.where("tokens > 0").join(used.select("source", "blocks"), "source").withColumn("block", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), "blocks"))
        self.placed = placed.select("doc_id", "source", "tokens", "block")
        blocks = self.placed.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"))
        turns = blocks.join(used, "source").withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("repeats")))).withColumn("order", F.xxhash64(F.lit(seed), "turn", "block"))
        run = running_sums(turns, ["source"], [F.col("turn"), F.col("order"), F.col("block")], {"upto": F.col("tokens"), "ordinal": F.lit(1)})
        # what is left of the quota where a block begins; the last block has more
        draws = run.withColumn("left", F.col("quota") - F.col("upto") + F.col("tokens")).where("left > 0").select("source", "block", "turn", (F.col("ordinal") - 1).alias("ordinal"), "tokens", "left")
        draws = materialize(draws, "draws")
        totals = draws.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.least("tokens", "left")).alias("t")).orderBy("source").toPandas()
        shards = max(1, min(int(totals["n"].sum()), -(-int(totals["t"].sum()) // shard_tokens)))
        names, quotas = totals["source"].tolist(), totals["n"].to_numpy(np.int64)

        def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for k in pdf["id"]:
                    n, start = shard_quotas(quotas, shards, int(k), seed)
                    yield pd.DataFrame({"shard": int(k), "source": names, "n": n, "start": start})

        schema = "shard int, source string, n bigint, start bigint"
        tree = docs.sparkSession.range(shards).mapInPandas(split, schema) if names else docs.sparkSession.createDataFrame([], schema)
        owner = tree.where("n > 0").select("shard", "source", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n") - 1)).alias("ordinal"))
        #: (source, block, turn, shard, tokens, left)
        self.draws = materialize(draws.join(owner, ["source", "ordinal"]).drop("ordinal"), "owned")
        self.seed = seed

    def taken(self) -> DataFrame:
        """(doc_id, source, turn, shard, tokens): the documents of the mix."""
        columns = ["doc_id", "source", "turn", "shard", "tokens"]
        whole = self.placed.join(self.draws.where("tokens <= left").select("source", "block", "turn", "shard"), ["source", "block"])
        # one block of each source
        last = self.placed.join(self.draws.where("tokens > left").select("source", "block", "turn", "shard", "left"), ["source", "block"])
        order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(self.seed), "doc_id", "turn"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
        last = last.withColumn("upto", F.sum("tokens").over(order)).where(F.col("upto") - F.col("tokens") / 2 <= F.col("left"))
        return whole.select(columns).unionByName(last.select(columns))

    def rows(self) -> DataFrame:
        """(shard, position, doc_id, source, turn, tokens): the mix, every shard shuffled by itself."""
        order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(self.seed), "shard", "doc_id", "turn"), "doc_id", "turn")
        return self.taken().select("shard", F.row_number().over(order).alias("position"), "doc_id", "source", "turn", "tokens")

    def shares(self) -> DataFrame:
        """(source, target, repeats, available, tokens, share, turns): what each source was to give and gave."""
        gave = self.taken().groupBy("source").agg(F.sum("tokens").alias("tokens"), F.max("turn").alias("turns"))
        out = self.plan.join(gave, "source", "left").withColumns({"tokens": F.coalesce("tokens", F.lit(0)), "turns": F.coalesce("turns", F.lit(0))})
        total = out.agg(F.sum("tokens").alias("all"))
        return out.join(F.broadcast(total)).select("source", "target", "repeats", "available", "tokens", F.when(F.col("all") > 0, F.col("tokens") / F.col("all")).otherwise(0.0).alias("share"), "turns")
