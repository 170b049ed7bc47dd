"""Splitting oversized units at natural boundaries by recursive bisection."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.tokens import encoder
from bookloom.operators.ranking import rank_in_groups
from bookloom.session import materialize

#: A unit's largest size in bytes of UTF-8.
LIMIT_BYTES = 6000
#: Bytes kept free for each token of overlap.
BYTES_PER_TOKEN = 6

#: Ends of pauses in a text, strongest first: after a blank line, a line, a sentence, a word.
PAUSES = [(4, re.compile(r"\n[ \t\r]*\n\s*")), (3, re.compile(r"\n")), (2, re.compile(r"[.!?…;]+[\"'”’»)\]]*[ \t\r]+")), (1, re.compile(r"[ \t\r ]+"))]
_BLANK = re.compile(r"\n(?:[ \t\r]*\n)+")


def byte_starts(text: str) -> np.ndarray:
    """Offset in bytes of UTF-8 of every code point, and the total at the end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    out = np.zeros(len(codes) + 1, dtype=np.int64)
    np.cumsum(1 + (codes > 0x7F) + (codes > 0x7FF) + (codes > 0xFFFF), out=out[1:])
    return out


def largest_block(text: str) -> int:
    """Bytes of the largest paragraph, its inner line ends counted and its last one not."""
    body = re.sub(r"(?:\n[ \t\r]*)+\Z", "", re.sub(r"\A(?:[ \t\r]*\n)+", "", text))
    return max((len(x.rstrip("\r\n").encode("utf-8", "surrogatepass")) for x in _BLANK.split(body) if x.strip(" \t\r\n")), default=0)


def strengths(text: str) -> np.ndarray:
    """For each place a cut may fall (before that code point) how strong the pause there is."""
    out = np.zeros(len(text) + 1, dtype=np.int8)
    for strength, pattern in reversed(PAUSES):
        for m in pattern.finditer(text):
            out[m.end()] = max(out[m.end()], strength)
    return out


def bisect(text: str, limit: int) -> list[tuple[int, int]]:
    """Pieces (start, end) of at most ``limit`` bytes that follow one another and cover the text.

    A piece over the limit is cut at the strongest pause in its middle half,
    the nearest to the midpoint among equals; without any pause it is cut
    between code points.  ``limit`` must be at least 4.
    """
    if limit < 4:
        raise ValueError("a limit under 4 bytes cannot hold every code point")
    at, strong = byte_starts(text), strengths(text)
    todo, done = [(0, len(text))], []
    while todo:
        s, e = todo.pop()
        size = at[e] - at[s]
        if size <= limit:
            done.append((s, e))
            continue
        lo, hi = (int(np.searchsorted(at, at[s] + size * q // 4)) for q in (1, 3))
        lo, hi = max(lo, s + 1), min(max(hi, s + 1), e - 1)
        window = strong[lo : hi + 1]
        best = np.flatnonzero(window == window.max()) + lo
        cut = int(best[np.argmin(np.abs(2 * (at[best] - at[s]) - size))])
        todo += [(cut, e), (s, cut)]
    return done


def overlap_start(text: str, start: int, cut: int, tokens: int, room: int, encode) -> tuple[int, int]:
    """(where the overlap before ``cut`` begins, its tokens): at most ``tokens`` tokens and ``room`` bytes, not before ``start``."""
    if tokens <= 0 or room <= 0 or cut <= start:
        return cut, 0
    tail = text[max(start, cut - room) : cut]
    raw = tail.encode("utf-8", "surrogatepass")
    ids = encode.encode_ordinary(raw.decode("utf-8", "replace"))[-tokens:]
    size = min(sum(map(len, encode.decode_tokens_bytes(ids))), len(raw), room)
    kept = raw[len(raw) - size :].decode("utf-8", "ignore") if size else ""
    return cut - len(kept), len(ids)


def cut_text(text: str, limit: int, overlap: int, encode) -> list[tuple[int, int, int, int]]:
    """(start with overlap, start, end, tokens of overlap) of each piece; every piece with its overlap is within ``limit`` bytes.

    An overlap has ``BYTES_PER_TOKEN`` bytes a token and half the limit at most,
    and is the piece before at most, so it can have fewer tokens than asked for.
    """
    if len(text.encode("utf-8", "surrogatepass")) <= limit:
        return [(0, 0, len(text), 0)]
    room = min(overlap * BYTES_PER_TOKEN, limit // 2)
    spans = bisect(text, limit - room)
    begins = [(0, 0)] + [overlap_start(text, spans[i - 1][0], s, overlap, room, encode) for i, (s, _) in enumerate(spans[1:], 1)]
    return [(a, s, e, n) for (a, n), (s, e) in zip(begins, spans)]


def current_units(units: DataFrame) -> DataFrame:
    """One row per work and unit: the latest loaded, then the greatest content.  Null keys are dropped."""
    rows = units.where("workId IS NOT NULL AND unitIndex IS NOT NULL")
    newest = F.max(F.struct("loadedAt", "content", "corpus", "title")).alias("r")
    return rows.groupBy("workId", "unitIndex").agg(newest).select("workId", "unitIndex", F.col("r.content").alias("content"), F.coalesce("r.corpus", F.lit("null")).alias("corpus"), F.col("r.title").alias("title"))


def cut_units(units: DataFrame, overlaps: DataFrame, limit: int = LIMIT_BYTES, text: bool = True) -> DataFrame:
    """(workId, unitIndex, piece, pieces, overlapChars, overlapTokens, bytes, unitBytes, blockBytes[, content]) of every unit.

    ``overlaps`` holds (corpus, overlap_tokens), one row per corpus, a small
    configuration table.  Null content is one empty piece.  A unit within the
    limit is one piece without overlap.
    """
    per_corpus = overlaps.groupBy("corpus").agg(F.max("overlap_tokens").alias("overlap"))
    rows = units.join(per_corpus, "corpus", "left").select("workId", "unitIndex", F.coalesce("content", F.lit("")).alias("content"), F.coalesce("overlap", F.lit(0)).alias("overlap"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        for pdf in batches:
            out = []
            for work, unit, content, overlap in zip(pdf["workId"], pdf["unitIndex"], pdf["content"], pdf["overlap"]):
                size, block = len(content.encode("utf-8", "surrogatepass")), largest_block(content)
                pieces = cut_text(content, limit, int(overlap), encode)
                for k, (a, s, e, tokens) in enumerate(pieces, 1):
                    body = content[a:e]
                    out.append((work, unit, k, len(pieces), s - a, tokens, len(body.encode("utf-8", "surrogatepass")), size, block, *([body] if text else [])))
            yield pd.DataFrame(out, columns=names)

    schema = "workId string, unitIndex bigint, piece int, pieces int, overlapChars int, overlapTokens int, bytes bigint, unitBytes bigint, blockBytes bigint" + ", content string" * text
    names = [c.split()[0] for c in schema.split(", ")]
    return rows.mapInPandas(cut, schema)


def split_units(units: DataFrame, limits: DataFrame, profile: str = "large", limit: int = LIMIT_BYTES) -> DataFrame:
    """Pieces within ``limit`` bytes, numbered anew per work: workId, unitIndex, unitCount, fromUnit, piece, overlapChars, overlapTokens, bytes, content.

    The overlap is the ``overlap_tokens`` of the profile in ``limits``.  Pieces
    without their overlaps, in order, give back each unit's content exactly.
    Works of any number of units are numbered by a range partition.
    """
    pieces = materialize(cut_units(current_units(units), limits.where(F.lower("profile") == profile), limit), "pieces")
    keys = rank_in_groups(pieces.select("workId", "unitIndex", "piece"), ["workId"], [F.col("unitIndex"), F.col("piece")], out="newIndex", total="unitCount")
    out = pieces.join(keys, ["workId", "unitIndex", "piece"])
    return out.select("workId", F.col("newIndex").cast("bigint").alias("unitIndex"), F.col("unitCount").cast("bigint").alias("unitCount"), F.col("unitIndex").alias("fromUnit"), "piece", "overlapChars", "overlapTokens", "bytes", "content")
