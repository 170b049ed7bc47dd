"""Long spans that stand word for word in more than one record.

Paragraphs are taken as every run of ``min_len`` code points, so a passage is
found wherever it begins.  The MinHash of such a run is the least hash of its
grams; one band of one row makes recall certain, because runs that are equal
have equal minima.  Only the distinct minima are kept (about one for every fifty
code points), records that collide are joined, the runs are verified code point
by code point, and removals are clustered by connected components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookloom.llm.grams import CHUNK, SECOND, Powers, anchors, gram_hashes
from bookloom.operators.graph import components
from bookloom.session import materialize

#: A shared passage has at least this many code points.
MIN_LEN = 200
#: Code points of a gram; a run's MinHash is the least over its grams.
GRAM = 90
#: A minimum held by more records than this is not joined pair by pair but refined to whole runs first.
HOT = 1000
#: The same where no pairs are asked for.
FEW = 50


def _signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _pieces(texts: list[str], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(code points, numbers of the texts, their ends, place of the first code point) of short texts together and of long ones in overlapping parts.

    No piece has more than ``CHUNK`` code points and the overlap.
    """

    def made(parts: list[str], numbers: list[int], at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        codes = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        return codes, np.array(numbers), np.cumsum([len(p) for p in parts]), at

    some, numbers, size = [], [], 0
    for i, text in enumerate(texts):
        if len(text) > CHUNK:
            for lo in range(0, len(text) - overlap, CHUNK):
                yield made([text[lo : lo + CHUNK + overlap]], [i], lo)
            continue
        if size + len(text) > CHUNK:
            yield made(some, numbers, 0)
            some, numbers, size = [], [], 0
        some.append(text)
        numbers.append(i)
        size += len(text)
    if some:
        yield made(some, numbers, 0)


def _digest(text: str) -> tuple[int, int]:
    d = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:16], "big", signed=True)


def span_anchors(docs: DataFrame, min_len: int = MIN_LEN, gram: int = GRAM) -> DataFrame:
    """(h, g, doc, pos): the distinct MinHashes of each text's runs, and one row at -1 with the SHA-256 (in part) of the whole text.

    Null texts and texts shorter than ``min_len`` give no row.  Texts are hashed
    as arrays of about ``CHUNK`` code points, long ones in overlapping parts, so
    a text of any length takes little memory beside its own.
    """
    w = min_len - gram + 1

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(CHUNK + min_len)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            whole = np.array([_digest(t) for t in texts], dtype=np.int64).reshape(-1, 2)
            hs, docs, at = [whole[:, 0]], [ids], [np.full(len(ids), -1, dtype=np.int32)]
            for codes, numbers, ends, first in _pieces(texts, min_len - 1):
                places, hashes = anchors(codes, gram, w, powers, ends)
                k = np.searchsorted(ends, places, side="right")
                hs.append(_signed(hashes))
                docs.append(ids[numbers[k]])
                at.append((places - np.concatenate(([0], ends))[k] + first).astype(np.int32))
            h = np.concatenate(hs)
            g = np.concatenate((whole[:, 1], np.zeros(len(h) - len(ids), dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(g), pa.array(np.concatenate(docs)), pa.array(np.concatenate(at))], names=["h", "g", "doc", "pos"])

    rows = docs.where(f"doc_id IS NOT NULL AND length(text) >= {min_len}").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(hashed, "h bigint, g bigint, doc bigint, pos int")


def _copies(shared: DataFrame) -> DataFrame:
    """(doc, rep): every record whose whole text stands in another (128 bits of its SHA-256 agree), with the smallest such record."""
    whole = shared.where("pos = -1")
    return whole.join(whole.groupBy("h", "g").agg(F.min("doc").alias("rep")), ["h", "g"]).select("doc", "rep")


def _contexts(need: DataFrame, docs: DataFrame, before: int, after: int) -> DataFrame:
    """(doc, pos, lead, tail): the text before and after ``pos``, cut at the text's own ends."""
    per_doc = need.groupBy("doc").agg(F.collect_set("pos").alias("ps"))
    rows = per_doc.join(docs.select(F.col("doc_id").cast("bigint").alias("doc"), "text").where(f"length(text) >= {MIN_LEN}"), "doc")
    rows = rows.select("doc", "text", F.explode("ps").alias("pos"))
    lead = F.expr(f"substring(text, greatest(pos - {before}, 0) + 1, least(pos, {before}))")
    return rows.select("doc", "pos", lead.alias("lead"), F.expr(f"substring(text, pos + 1, {after})").alias("tail"))


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[:mid] == b[:mid] else (lo, mid)
    return lo


def _verified(rare: DataFrame, docs: DataFrame, min_len: int, gram: int) -> DataFrame:
    """(a, b, start_a, start_b, len): maximal common runs of at least ``min_len`` through shared minima."""
    x, y = (rare.select("h", F.col("doc").alias(s), F.col("pos").alias(f"p{s}")) for s in "ab")
    hits = x.join(y, "h").where("a < b").select("a", "b", "pa", (F.col("pa") - F.col("pb")).alias("diag")).distinct()
    line = Window.partitionBy("a", "b", "diag").orderBy("pa")
    hits = hits.withColumn("new", F.when(F.col("pa") - F.lag("pa").over(line) <= gram, 0).otherwise(1))
    runs = hits.withColumn("seg", F.sum("new").over(line)).groupBy("a", "b", "diag", "seg").agg(F.min("pa").alias("first"), F.max("pa").alias("last"))
    runs = materialize(runs, "runs")
    reach = min_len - gram
    ends = F.inline(F.array(*[F.struct(F.col(d).alias("doc"), p.cast("int").alias("pos")) for d, off in (("a", F.lit(0)), ("b", F.col("diag"))) for p in (F.col("first") - off, F.col("last") - off)]))
    around = materialize(_contexts(runs.select(ends), docs, reach, gram + reach), "around")
    for d, off in (("a", F.lit(0)), ("b", F.col("diag"))):
        for end, col in (("first", "lead"), ("last", "tail")):
            side = around.select(F.col("doc").alias(d), F.col("pos").alias("_p"), F.col(col).alias(f"{col}_{d}"))
            runs = runs.withColumn("_p", (F.col(end) - off).cast("int")).join(side, [d, "_p"]).drop("_p")

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            left = [_common(p[::-1], q[::-1]) for p, q in zip(pdf["lead_a"], pdf["lead_b"])]
            right = [_common(p, q) for p, q in zip(pdf["tail_a"], pdf["tail_b"])]
            start = pdf["first"] - left
            size = pdf["last"] + right - start
            out = pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "start_a": start, "start_b": start - pdf["diag"], "len": size, "ok": [r >= gram for r in right]})
            yield out[out["ok"] & (out["len"] >= min_len)].drop(columns="ok")

    return runs.mapInPandas(measure, "a bigint, b bigint, start_a int, start_b int, len int")


def _whole_runs(hot: DataFrame, docs: DataFrame, min_len: int, gram: int) -> DataFrame:
    """(h, g, doc, start): two independent hashes of every run of ``min_len`` code points around the minima of ``hot``."""
    reach = min_len - gram

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers, others = Powers(2 * min_len), Powers(2 * min_len, SECOND)
        for pdf in batches:
            out = []
            for doc, pos, lead, tail in zip(pdf["doc"], pdf["pos"], pdf["lead"], pdf["tail"]):
                codes = np.frombuffer((lead + tail).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                h, g = (gram_hashes(codes, min_len, p) for p in (powers, others))
                out.append(pd.DataFrame({"h": _signed(h), "g": _signed(g), "doc": doc, "start": np.arange(len(h)) + pos - len(lead)}))
            yield pd.concat(out) if out else pd.DataFrame({"h": [], "g": [], "doc": [], "start": []})

    around = _contexts(hot.select("doc", "pos"), docs, reach, gram + reach)
    return around.mapInPandas(runs, "h bigint, g bigint, doc bigint, start int").distinct()


class SharedSpans:
    """Shared passages of a table (doc_id, text): the steps both results are made from."""

    def __init__(self, docs: DataFrame, min_len: int = MIN_LEN, gram: int = GRAM, hot: int = HOT) -> None:
        found = materialize(span_anchors(docs, min_len, gram), "minima")
        several = found.groupBy("h", "g").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h", "g")
        shared = materialize(found.join(several, ["h", "g"]), "shared")
        #: (doc, rep) of all records with copies, the representative itself included.
        self.members = materialize(_copies(shared), "copies")
        alone = shared.where("pos >= 0").join(self.members.where("doc > rep").select("doc"), "doc", "left_anti")
        counts = alone.groupBy("h").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi").select("h", "n")
        rows = materialize(alone.join(counts, "h"), "alone")
        #: (a, b, start_a, start_b, len) of representatives whose common minima are not hot.
        self.spans = materialize(_verified(rows.where(F.col("n") <= hot), docs, min_len, gram), "spans")
        many = rows.where(F.col("n") > hot)
        self.hot = None
        if many.limit(1).count():
            runs = materialize(_whole_runs(many, docs, min_len, gram), "runs")
            again = runs.groupBy("h", "g").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).where("lo < hi").select("h", "g")
            #: (h, g, doc, start) of whole runs shared by several representatives.
            self.hot = materialize(runs.join(again, ["h", "g"]), "hotruns")
        self.min_len = min_len

    def pairs(self) -> DataFrame:
        """(doc_id_a, doc_id_b), a < b: every two records with a common run, copies included."""
        reps = self.spans.select("a", "b").distinct()
        if self.hot is not None:
            x, y = (self.hot.select("h", "g", F.col("doc").alias(s)).distinct() for s in "ab")
            reps = reps.unionByName(x.join(y, ["h", "g"]).where("a < b").select("a", "b")).distinct()
        for side in "ab":
            copies = self.members.select(F.col("rep").alias(side), F.col("doc").alias(f"{side}_doc"))
            reps = reps.join(copies, side, "left").withColumn(f"{side}_doc", F.coalesce(f"{side}_doc", side))
        across = reps.select(F.least("a_doc", "b_doc").alias("doc_id_a"), F.greatest("a_doc", "b_doc").alias("doc_id_b"))
        x, y = (self.members.select("rep", F.col("doc").alias(f"doc_id_{s}")) for s in "ab")
        within = x.join(y, "rep").where("doc_id_a < doc_id_b").select("doc_id_a", "doc_id_b")
        return across.unionByName(within).distinct()

    def links(self) -> DataFrame:
        """(a, b): links that tie the same records together as :meth:`pairs`, linear in the rows."""
        out = self.spans.select("a", "b").unionByName(self.members.where("doc > rep").select(F.col("doc").alias("a"), F.col("rep").alias("b")))
        if self.hot is not None:
            first = self.hot.groupBy("h", "g").agg(F.min("doc").alias("b"))
            out = out.unionByName(self.hot.join(first, ["h", "g"]).where("doc > b").select(F.col("doc").alias("a"), "b"))
        return out.distinct()

    def shares(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_chars, passages, shared_chars, share, component, keep) of every record.

        ``shared_chars`` counts the code points of the record inside passages
        that stand elsewhere too; ``component`` is the smallest record it is
        tied to, null without any; ``keep`` is false for records of a component
        other than its smallest.  Null texts share nothing.
        """
        sides = [self.spans.select(F.col(s).alias("doc"), F.col(f"start_{s}").alias("s"), (F.col(f"start_{s}") + F.col("len")).alias("e")) for s in "ab"]
        parts = sides[0].unionByName(sides[1])
        if self.hot is not None:
            parts = parts.unionByName(self.hot.select("doc", F.col("start").alias("s"), (F.col("start") + self.min_len).alias("e")))
        before = Window.partitionBy("doc").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
        gaps = parts.distinct().withColumn("m", F.coalesce(F.max("e").over(before), F.lit(-1)))
        own = gaps.groupBy("doc").agg(F.count_if(F.col("s") > F.col("m")).alias("passages"), F.sum(F.greatest(F.col("e") - F.greatest("s", "m"), F.lit(0))).alias("chars"))
        sizes = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc"), F.coalesce(F.length("text"), F.lit(0)).cast("bigint").alias("n_chars"))
        tied = components(self.links()).select(F.col("node").alias("doc"), "component")
        rows = sizes.join(own, "doc", "left").join(self.members.select("doc", "rep"), "doc", "left").join(tied, "doc", "left")
        chars = F.when(F.col("rep").isNotNull(), F.col("n_chars")).otherwise(F.coalesce("chars", F.lit(0)))
        passages = F.when(F.col("rep").isNotNull(), F.lit(1)).otherwise(F.coalesce("passages", F.lit(0)))
        rows = rows.withColumns({"shared_chars": chars.cast("bigint"), "passages": passages.cast("bigint")})
        share = F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(0.0)
        return rows.select(F.col("doc").alias("doc_id"), "n_chars", "passages", "shared_chars", share.alias("share"), "component", (F.col("component").isNull() | (F.col("component") == F.col("doc"))).alias("keep"))
