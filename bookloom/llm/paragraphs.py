"""Paragraphs shared between records, by MinHash banding.

Paragraphs are parted by blank lines and taken as words.  Equal ones are one
row from the start.  A paragraph's MinHash signature is cut into bands, as many
and as long as the wanted recall at the threshold allows (:func:`tuned_bands`);
paragraphs that collide in a band are joined and verified by the exact Jaccard
similarity of their shingles of five words; classes are the connected components
of the verified links, and of each class all occurrences but the first go.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.operators.graph import components
from bookloom.operators.skew import split_join
from bookloom.session import materialize

#: Words of a shingle, least Jaccard similarity, hashes of a signature at most, least recall of a pair at the threshold.
WORDS, SIMILAR, HASHES, RECALL = 5, 0.8, 40, 0.99
#: Shingles hashed at a time; small enough for the processor's cache.
CHUNK = 1 << 15
#: Paragraphs to be verified that are sent to all executors at most; more are joined.
SENT = 500_000
_MULTIPLIERS = np.random.default_rng(17).integers(1, 2**63, HASHES, dtype=np.uint64) | np.uint64(1)
_OFFSETS = np.random.default_rng(18).integers(0, 2**63, HASHES, dtype=np.uint64)
_BREAK = re.compile(r"\n[ \t\r]*\n[ \t\r\n]*")
_WORD = re.compile(r"[^\W_]+")


def tuned_bands(similar: float = SIMILAR, hashes: int = HASHES, recall: float = RECALL) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold collides at least with the wanted probability."""
    fits = [(b, r) for r in range(1, hashes + 1) for b in [hashes // r] if 1 - (1 - similar**r) ** b >= recall]
    return fits[-1] if fits else (hashes, 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingle_hashes(words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, paragraph of each) of all runs of ``WORDS`` words; a shorter paragraph is one run, an empty one none."""
    padded = np.concatenate((words, np.zeros(WORDS, dtype=np.uint64)))
    ends = np.cumsum(sizes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    first = at == (ends - sizes)[of]
    whole = (at + WORDS <= ends[of]) | first
    at, of = at[whole], of[whole]
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(WORDS):
        inside = at + k < ends[of]
        total = total * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, padded[at + k], np.uint64(k))
    return _mixed(total), of


def band_values(hashes: np.ndarray, of: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(paragraphs, bands): for each paragraph, that has a shingle, one value of 32 bits for each band of its MinHash signature."""
    starts = np.flatnonzero(np.diff(of, prepend=-1))
    value = np.zeros((bands, len(starts)), dtype=np.uint64)
    cuts = [0, *(np.searchsorted(starts, range(CHUNK, len(hashes), CHUNK)).tolist()), len(starts)]
    for lo, hi in zip(cuts, cuts[1:]):
        if lo < hi:
            begin, end = starts[lo], starts[hi] if hi < len(starts) else len(hashes)
            part, inner = hashes[begin:end], starts[lo:hi] - begin
            for k in range(bands * rows):
                value[k // rows, lo:hi] = value[k // rows, lo:hi] * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(part * _MULTIPLIERS[k] + _OFFSETS[k], inner)
    return (_mixed(value) >> np.uint64(32)).T


def parted(texts: list[str | None]) -> tuple[list[tuple[int, int, int, str]], np.ndarray, np.ndarray]:
    """((number of the text, place, characters, words joined) of each paragraph that has a word, hashes of all words, words of each)."""
    rows, words, sizes = [], [], []
    for i, text in enumerate(texts):
        for place, paragraph in enumerate(_BREAK.split(text)) if text else ():
            own = _WORD.findall(paragraph.lower())
            if own:
                rows.append((i, place, len(paragraph), " ".join(own)))
                words += own
                sizes.append(len(own))
    coded = pa.array(words, type=pa.string()).dictionary_encode()
    named = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    return rows, named[coded.indices.to_numpy()] if words else np.zeros(0, dtype=np.uint64), np.array(sizes, dtype=np.int64)


def paragraph_rows(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """(doc, pos, chars, key, bands): every paragraph that has a word, with 128 bits of a hash of its words in order, and its bands.

    Null texts have none.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            made, words, sizes = parted(batch.column(1).to_pylist())
            values = band_values(*shingle_hashes(words, sizes), bands, rows)
            keys = [hashlib.blake2b(m[3].encode("utf-8", "surrogatepass"), digest_size=16).digest() for m in made]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1, dtype=np.int32) * bands), pa.array(np.ascontiguousarray(values).reshape(-1).astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[[m[0] for m in made]].astype(np.int64)), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.int32()), pa.array(keys, pa.binary()), lists], names=["doc", "pos", "chars", "key", "bands"])

    texts = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc"), "text")
    return texts.mapInArrow(read, "doc bigint, pos int, chars int, key binary, bands array<int>")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(key, s): the different shingles of the paragraphs (key, pos) listed in ``wanted`` of each text."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, paragraphs = [], []
            for text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = _BREAK.split(text)
                keys += [w["key"] for w in wanted]
                paragraphs += [own[w["pos"]] for w in wanted]
            _, words, sizes = parted(paragraphs)
            hashes, of = shingle_hashes(words, sizes)
            offsets = np.searchsorted(of, np.arange(len(sizes) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(hashes.view(np.int64)))], names=["key", "shingles"])

    return texts.select("text", "wanted").mapInArrow(read, "key binary, shingles array<bigint>").select("key", F.array_distinct("shingles").alias("s"))


class Paragraphs:
    """Paragraphs of a table (doc_id, text), their links and classes."""

    def __init__(self, docs: DataFrame, similar: float = SIMILAR) -> None:
        bands, rows = tuned_bands(similar)
        self.rows = materialize(paragraph_rows(docs, bands, rows), "paragraphs")
        n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        # equal paragraphs are one from here on; one shuffle by band value then serves both the search for values of several and their rows
        unique = self.rows.groupBy("key").agg(F.first("bands").alias("bands"))
        each = unique.select(F.posexplode("bands").alias("band", "x"), "key").select((F.shiftleft(F.col("band").cast("bigint"), 32) + F.col("x")).alias("value"), "key").repartition(n, "value")
        several = each.groupBy("value").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo < hi").select("value")
        held = materialize(each.join(several, "value"), "bands")
        pairs = split_join(held.withColumnRenamed("key", "a"), held.withColumnRenamed("key", "b"), ["value"]).where("a < b").select("a", "b").distinct()
        pairs = materialize(pairs, "pairs")
        needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
        first = self.rows.select("key", "doc", "pos").join(needed, "key", "left_semi").groupBy("key").agg(F.min(F.struct("doc", "pos")).alias("m"))
        first = materialize(first.select("key", F.col("m.doc").alias("doc"), F.col("m.pos").alias("pos")), "first")
        places = first.groupBy("doc").agg(F.collect_list(F.struct("key", "pos")).alias("wanted"))
        places = F.broadcast(places) if first.count() <= SENT else places
        texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc"), "text").join(places, "doc")
        sets = materialize(shingle_sets(texts), "shingles")
        both = pairs.join(sets.select(F.col("key").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("s").alias("y")), "b")
        # sizes alone rule out most pairs that collide by chance
        both = both.where(F.least(F.size("x"), F.size("y")) >= similar * F.greatest(F.size("x"), F.size("y"))).withColumn("common", F.size(F.array_intersect("x", "y")))
        both = both.withColumn("similarity", F.col("common") / (F.size("x") + F.size("y") - F.col("common")))
        #: (a, b, similarity) of different paragraphs of at least the threshold.
        self.links = materialize(both.where(F.col("similarity") >= similar).select("a", "b", "similarity"), "links")
        #: (key, class) of paragraphs with links.
        self.classes = materialize(components(self.links).select(F.col("node").alias("key"), F.col("component").alias("class")), "classes")

    def shares(self, docs: DataFrame) -> DataFrame:
        """(doc_id, paragraphs, shared, shared_chars, removed, removed_chars) of every record.

        Shared is a paragraph whose class stands in another record too; removed
        is one that stands, in its class, in an earlier record or earlier in this.
        """
        rows = self.rows.select("doc", "pos", "chars", "key").join(self.classes, "key", "left").withColumn("class", F.coalesce("class", "key"))
        first = F.min(F.struct("doc", "pos")).alias("first")
        groups = rows.groupBy("class").agg(first, F.min("doc").alias("lo"), F.max("doc").alias("hi"))
        marked = rows.join(groups, "class").withColumns({"s": F.col("lo") < F.col("hi"), "r": F.struct("doc", "pos") != F.col("first")})
        total = lambda flag: F.sum(F.when(F.col(flag), F.col("chars").cast("bigint")).otherwise(0))
        own = marked.groupBy(F.col("doc").alias("doc_id")).agg(F.count(F.lit(1)).alias("paragraphs"), F.count_if("s").alias("shared"), total("s").alias("shared_chars"), F.count_if("r").alias("removed"), total("r").alias("removed_chars"))
        return docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id")).join(own, "doc_id", "left").na.fill(0)
