"""Repair of text from scanned pages.

Lines of a unit are first told apart: running text, running headers, page
numbers, the converter's page marks, headings.  Skip-gram vectors are learnt on
the running text of all units: a word's vector holds, for each of ``BUCKETS``
buckets of context words, the pointwise mutual information of the two, which is
what the product of a word's and a context's vector comes to when skip-grams are
trained to the end (Levy and Goldberg, 2014).  It is made of counts, so it needs
no passes over the data and no state on the driver.  A rare word is linked to a
frequent one where a scanner may have misread it (``rn`` for ``m``, ``1`` for
``l``, a lost character) and the frequent word's vector expects the company the
rare word keeps.  Every link is weighed again in the context of each occurrence,
furniture is removed, words cut at line ends are joined, and the lines are
reflowed into paragraphs.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.llm.split import current_units
from bookloom.session import materialize

#: A word is rare beside another that is this many times as frequent.
TIMES = 8
#: Least count of a word that others are corrected to.
FREQUENT = 4
#: Buckets of context words, which bound a vector's length, and words on either side that are context.
BUCKETS, WINDOW = 4096, 3
#: Context words seen beforehand with every word, each as often as chance has it, so that few counts say little.
BEFORE = 20
#: What each letter of a word adds to the evidence that its likeness to another is no chance.
LETTER = 0.5
#: Tokens whose pairs are counted in one array.
CHUNK = 1 << 20
#: Characters of results that a Python task keeps before it hands them on.
LOT = 1 << 20

# Signs that scanners put for a letter.
SIGNS = {"0": "o", "1": "l", "!": "i", "|": "l", "9": "g", "+": "t", "8": "b", "6": "e", "3": "a", "5": "s", "$": "s", "ſ": "s"}
# Pairs of letters that look like one, in the order they are merged.
MERGED = [("rn", "m"), ("vv", "w"), ("ii", "u")]
# The same for pairs that overlap one another and the letters below, one choice after the other.
PAIRS = [[*MERGED, ("cl", "d"), ("li", "h")], [*MERGED, ("li", "h")], MERGED]
# Letters that look alike once their marks are gone.
ALIKE = {"c": "e", "b": "h", "f": "r"}

HYPHENS = "-¬­‐‑="
_CUT = re.compile(rf"[^\W_][{HYPHENS}]\s*$")
_MARK = re.compile(r"#{1,6}\s*(?:page|section)\s+\S+\s*$", re.I)
_HEADING = re.compile(r"(?:#{1,6}\s|(?:chapter|part|kapitola|kapitel|teil|chapitre|partie|část|book)\s+[\divxlcdm]+\b)", re.I)
_DIGITS = r"[0-9OolI]{1,4}"
_ROMAN = r"[ivxlcdmIVXLCDM]{1,9}"
_NUMBER = re.compile(rf"(?P<lead>[\[(\-–—~*·\s]*(?:(?:page|pag\.|pg\.|p\.|seite|s\.|str\.|strana)\s*)?)(?P<n>{_DIGITS}|{_ROMAN})(?P<of>\s*(?:/|of|von|z|sur|de)\s*{_DIGITS})?(?P<tail>[\])\-–—~*·.\s]*)$", re.I)
_AROUND = re.compile(rf"^(?:(?P<a>{_DIGITS}|{_ROMAN})\s{{2,}}(?P<x>.+?)|(?P<y>.+?)\s{{2,}}(?P<b>{_DIGITS}|{_ROMAN}))$")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'.,;:?!“”„‘’()[]{}<>«»–—…*_~`#"
_NOTE = re.compile(r"\[\d+\]")


_SIGNS = str.maketrans(SIGNS | dict.fromkeys("!|+$"))
_NO_WORD = re.compile(r"[\W_]+")


def plain(text: str) -> str:
    """Letters and digits only, marks stripped, scanner signs replaced; spaced-out letters become one string."""
    flat = text.lower().translate(_SIGNS)
    return _NO_WORD.sub("", flat if flat.isascii() else unicodedata.normalize("NFD", flat))


def skeletons(word: str) -> list[str]:
    """What is left of a word once look-alike glyphs are made equal; several where pairs of letters overlap."""
    w = "".join(SIGNS.get(c, c) for c in word.lower())
    w = "".join(c for c in unicodedata.normalize("NFKD", w) if not unicodedata.combining(c))
    out = []
    for pairs in PAIRS:
        x = w
        for pair, one in pairs:
            x = x.replace(pair, one)
        out.append("".join(ALIKE.get(c, c) for c in x))
    return list(dict.fromkeys(out))


def page_value(text: str) -> int:
    """The value of a page number in digits (O, I and l read as 0, 1 and 1) or Roman numerals, or -1."""
    digits = text.replace("O", "0").replace("o", "0").replace("l", "1").replace("I", "1")
    if re.search(r"\d", text) and digits.isdigit():
        return int(digits)
    total, values = 0, {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
    nums = [values.get(c, 0) for c in text.lower()]
    if not nums or 0 in nums:
        return -1
    for a, b in zip(nums, [*nums[1:], 0]):
        total += -a if a < b else a
    return total if re.fullmatch(r"m*(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})", text.lower()) else -1


class Form:
    """A text that lines are compared with, as a whole or by its beginning."""

    def __init__(self, text: str) -> None:
        self.text = text
        self._matchers: dict[int, difflib.SequenceMatcher] = {}

    def like(self, p: str, least: float, most: int | None = None) -> bool:
        """Whether ``p`` and the first ``most`` characters are alike to at least ``least``."""
        size = len(self.text) if most is None else most
        m = self._matchers.get(size)
        if m is None:
            m = self._matchers[size] = difflib.SequenceMatcher(None, "", self.text[:size], autojunk=False)
        m.set_seq1(p)
        return m.real_quick_ratio() >= least and m.quick_ratio() >= least and m.ratio() >= least


def header_forms(author: str | None, title: str | None) -> list[str]:
    """What a running header of the book may say, as :func:`plain` text."""
    author, title = author or "", title or ""
    short = re.split(r":|\s[-–—]\s", title)[0]
    parts = [author, title, short]
    if "," in author:
        parts.append(" ".join(reversed([p.strip() for p in author.split(",", 1)])))
    both = [a + b for a in (parts[0], *parts[3:]) for b in (title, short) if a and b] + [b + a for a in (parts[0], *parts[3:]) for b in (title, short) if a and b]
    return [f for f in dict.fromkeys(plain(p) for p in [*parts, *both]) if len(f) >= 4]


def says_header(text: str, forms: list[Form]) -> bool:
    """Whether a line is one of the forms, the beginning of one, or one with a few glyphs misread."""
    p = plain(text)
    if len(p) < 6:
        return any(p == f.text for f in forms)
    for f in forms:
        size = len(f.text)
        if f.text.startswith(p) and len(p) >= min(size, 10):
            return True
        if abs(len(p) - size) <= 3 and f.like(p, 0.85):
            return True
        if size > len(p) >= 10 and f.like(p, 0.88, len(p)):
            return True
    return False


def line_kinds(lines: list[str], author: str | None, title: str | None) -> list[str]:
    """For each line: text, blank, mark, heading, running_header or page_number.

    A page number stands alone on its line and is either dressed as one
    (``p. 3``, ``- 3 -``, ``[3]``), or fits the other page numbers and marks of
    the unit, or stands beside a header or at an end of the unit.  Undressed
    numbers that follow one another are figures of the text.
    """
    forms = [Form(f) for f in header_forms(author, title)]
    stripped = [x.strip() for x in lines]
    kinds = ["text" if s else "blank" for s in stripped]
    seen: dict[str, int] = {}
    numbers: dict[int, tuple[int, bool]] = {}
    for i, s in enumerate(stripped):
        if not s:
            continue
        if _MARK.match(s):
            kinds[i] = "mark"
            continue
        if len(s) <= 24 and (m := _NUMBER.match(s)) and (v := page_value(m["n"])) > 0:
            dressed = bool(m["of"] or re.search(r"\w", m["lead"]) or (m["lead"].strip() and m["tail"].strip()))
            numbers[i] = (v, dressed)
            continue
        body, beside = s, False
        if m := _AROUND.match(s):
            n, rest = (m["a"], m["x"]) if m["a"] else (m["b"], m["y"])
            if page_value(n) > 0:
                body, beside = rest, True
        if len(s) <= 220 and (not s[:1].islower() or beside) and says_header(body, forms):
            kinds[i] = "running_header"
        elif _HEADING.match(s):
            kinds[i] = "heading"
        elif beside or (len(s) <= 90 and not re.search(r"[.!?;,:]$", s) and not s[0].islower()):
            seen[plain(body)] = seen.get(plain(body), 0) + 1
    for i, s in enumerate(stripped):  # headers that say something else, but the same on several pages
        if kinds[i] == "text" and i not in numbers and not s[0].islower() and (s.isupper() or s.istitle() or s.count("  ")) and seen.get(plain(s), 0) >= 2 and len(plain(s)) >= 6:
            kinds[i] = "running_header"
    full = [i for i, s in enumerate(stripped) if s]
    place = {i: k for k, i in enumerate(full)}
    marks = [int(re.search(r"\d+", stripped[i])[0]) for i in full if kinds[i] == "mark" and re.search(r"\d+", stripped[i])]
    sure = [v for v, dressed in numbers.values() if dressed] + marks
    bare = {i: v for i, (v, dressed) in numbers.items() if not dressed}

    def beside_bare(i: int) -> bool:
        near = [full[k] for k in (place[i] - 1, place[i] + 1) if 0 <= k < len(full)]
        return any(j in bare and bare[j] >= 100 for j in near) and bare[i] >= 1000

    single = {i: v for i, v in bare.items() if not beside_bare(i)}
    for i, (v, dressed) in numbers.items():
        k = place[i]
        if not dressed:
            if i not in single:
                continue
            near = {kinds[full[j]] for j in (k - 1, k + 1) if 0 <= j < len(full)}
            fits = any(0 < abs(v - w) <= 12 for j, w in single.items() if j != i) or any(abs(v - w) <= 12 for w in sure)
            edge = k in (0, len(full) - 1)
            if not (fits or (v < 1000 and (edge or near & {"running_header", "mark", "heading"} or re.search(r"[^\w\s]", stripped[i]) or stripped[i].isdigit() or len(stripped[i]) >= 2))):
                continue
        kinds[i] = "page_number"
    return kinds


_WORDLIKE = re.compile(r"[^\W\d_]|�")


def words_of(text: str) -> list[str]:
    """The words of a line without the signs around them, lower-cased; those without a letter are dropped."""
    out = []
    for raw in _NOTE.sub(" ", text).split() if "[" in text else text.split():
        if raw.isalpha():
            out.append(raw.lower())
            continue
        w = raw.strip(_EDGES).rstrip(HYPHENS).lower()
        if _WORDLIKE.search(w):
            out.append(w)
    return out


def unit_lines(content: str, author: str | None, title: str | None) -> list[tuple]:
    """(lineNo, kind, tokens, splits, headLength, tail, next, before, after) of each line that is not blank.

    ``splits``: the line ends with a hyphen inside a word; its last token is then
    the whole word, ``headLength`` characters of which are on this line, and the
    next text line begins after it.  ``tail`` and ``next`` are the words on
    either side of a line end without a hyphen.  ``before`` and ``after`` are
    the words of other text lines next to this one.
    """
    lines = content.split("\n")
    kinds = line_kinds(lines, author, title)
    text = [i for i, k in enumerate(kinds) if k == "text"]
    after: dict[int, int] = {}
    for a, b in zip(text, text[1:]):
        between = kinds[a + 1 : b]
        if all(k in ("running_header", "page_number", "mark", "blank") for k in between) and (not between or any(k != "blank" for k in between)):
            after[a] = b
    rows, skip = [], {}
    for i in text:
        body = lines[i].strip()
        tokens = words_of(body[skip.get(i, 0) :])
        splits, length, tail, head = False, 0, None, None
        j = after.get(i)
        nxt = lines[j].strip() if j is not None else ""
        if j is not None and _CUT.search(body) and nxt[:1].isalnum() and tokens:
            rest = _TOKEN.match(nxt)[0]
            last = _TOKEN.findall(body)[-1].strip(_EDGES).rstrip(HYPHENS).lower()
            whole = last + rest.strip(_EDGES).lower()
            splits, length = True, len(last)
            tokens = [*tokens[:-1], whole]
            skip[j] = len(rest)
        elif j is not None and body[-1:].isalnum() and nxt[:1].islower() and tokens:
            following = words_of(nxt)
            if following:
                tail, head = tokens[-1], following[0]
        rows.append((i + 1, "text", tokens, splits, length, tail, head))
    made = [(r[2], [], []) for r in rows]
    for (_, _, near), (words, _, _) in zip(made[1:], made):
        near += words[-WINDOW:]
    for (_, near, _), (words, _, _) in zip(made, made[1:]):
        near += words[:WINDOW]
    rows = [(*r, near, far) for r, (_, far, near) in zip(rows, made)]
    rows += [(i + 1, k, [], False, 0, None, None, [], []) for i, k in enumerate(kinds) if k in ("running_header", "page_number")]
    return rows


LINES = "workId string, unitIndex bigint, lineNo int, kind string, tokens array<string>, splits boolean, headLength int, tail string, next string, before array<string>, after array<string>"


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}


def in_lots(sized: Iterable[tuple[int, list[tuple]]], schema: str) -> Iterator[pa.RecordBatch]:
    """The rows of (characters, rows), handed on as soon as there are ``LOT`` characters of them.

    A task holds one lot as Python objects, however many rows Spark sends it at a time.
    """
    fields = pa.schema([(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), fields)], schema=fields)

    rows, have = [], 0
    for size, more in sized:
        rows += more
        have += size
        if have >= LOT and rows:
            yield batch(rows)
            rows, have = [], 0
    if rows:
        yield batch(rows)


def each_row(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in batch.columns)


def scanned_lines(units: DataFrame) -> DataFrame:
    """The lines of every unit (workId, unitIndex, content, author, title), see :func:`unit_lines`.  Null content has none."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = each_row(batches)
        return in_lots(((len(content), [(work, unit, *row) for row in unit_lines(content, author, title)]) for work, unit, content, author, title in rows), LINES)

    return units.where("content IS NOT NULL").select("workId", "unitIndex", "content", "author", "title").mapInArrow(read, LINES)


def glyph_keys(counts: DataFrame) -> DataFrame:
    """(key, word, n, wild): the skeletons of every word, and of every frequent word with each character lost."""

    schema = "key string, word string, n bigint, wild boolean"

    def sized(w: str, n: int) -> Iterator[tuple[int, list[tuple]]]:
        for k in skeletons(w):
            yield 2 * len(w), [(k, w, n, False)]
            if n >= FREQUENT and "�" not in w:
                yield from ((2 * len(w), [(k[:i] + "�" + k[i + 1 :], w, n, True)]) for i in range(len(k)))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return in_lots((x for w, n in each_row(batches) for x in sized(w, n)), schema)

    return counts.select("word", "n").mapInArrow(keys, schema)


def glyph_links(counts: DataFrame) -> DataFrame:
    """(word, better, n, m, odd): rare words and the frequent words a scanner may have misread as them.

    ``odd``: the word holds a sign that no word has.  A table of words against
    words, joined on their glyph skeletons.
    """
    keys = materialize(glyph_keys(counts), "glyphs")
    rare = keys.where("NOT wild").select("key", "word", "n").withColumn("odd", F.col("word").rlike(r"[0-9!|+$ſ\x{FFFD}]"))
    good = keys.where(F.col("n") >= FREQUENT).where(F.col("word").rlike(r"^[\p{L}'’\-]+$") & ~F.col("word").contains("ſ")).select("key", F.col("word").alias("better"), F.col("n").alias("m"))
    near = F.levenshtein("word", "better")
    close = (F.col("word") != F.col("better")) & (near <= 4) & (near * 2 <= F.length("better") + 1)
    return rare.join(good, "key").where(close & (F.col("odd") | (F.col("m") >= F.col("n") * TIMES))).select("word", "better", "n", "m", "odd").distinct()


def bucket(word: str) -> int:
    """The bucket of a context word; Spark's ``crc32`` gives the same."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def skip_grams(lines: DataFrame) -> DataFrame:
    """(word, bucket, n): how often each word has a word of each bucket within ``WINDOW`` words in its line or at the end of the text line before.

    Pairs are counted in arrays of ``CHUNK`` tokens and added up by Spark.
    """

    def count(words: list[pa.Array], places: list[np.ndarray], own: list[np.ndarray]) -> pa.RecordBatch:
        coded = pa.concat_arrays(words).dictionary_encode()
        names, codes, line = coded.dictionary, coded.indices.to_numpy(), np.concatenate(places)
        here = np.concatenate(own)
        of = np.array([bucket(w) for w in names.to_pylist()], dtype=np.int64)
        keys, end = np.empty(2 * WINDOW * len(codes), dtype=np.int64), 0
        for k in range(1, WINDOW + 1):
            same = (line[:-k] == line[k:]) & here[k:]
            x, y = codes[:-k][same], codes[k:][same]
            for word, other in ((x, y), (y, x)):
                np.add(word.astype(np.int64) * BUCKETS, of[other], out=keys[end : end + len(x)])
                end += len(x)
        keys = keys[:end]
        keys.sort()
        new = np.ones(end, dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        first = np.flatnonzero(new)
        keys, n = keys[first], np.diff(first, append=end)
        return pa.RecordBatch.from_arrays([names.take(pa.array(keys // BUCKETS)), pa.array((keys % BUCKETS).astype(np.int32)), pa.array(n)], names=["word", "bucket", "n"])

    def sizes_of(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column(0).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)

    def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes_of(batch)) // CHUNK)) + 1).tolist(), batch.num_rows]
        yield from (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, places, own, have, seen = [], [], [], 0, 0
        for batch in (part for batch in batches for part in parts(batch)):
            lists = batch.column(0)
            words.append(lists.flatten())
            sizes = sizes_of(batch)
            places.append(np.repeat(np.arange(seen, seen + len(lists)), sizes))
            within = np.arange(len(words[-1])) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            own.append(within >= np.repeat(batch.column(1).to_numpy(), sizes))
            have, seen = have + len(words[-1]), seen + len(lists)
            if have >= CHUNK:
                yield count(words, places, own)
                words, places, own, have = [], [], [], 0
        if have:
            yield count(words, places, own)

    text = lines.where("kind = 'text' AND size(tokens) > 0").select(F.concat("before", "tokens").alias("words"), F.size("before").alias("old"))
    return text.mapInArrow(counted, "word string, bucket int, n bigint").groupBy("word", "bucket").agg(F.sum("n").alias("n"))


def information(company: DataFrame, grams: DataFrame, key: list[str]) -> DataFrame:
    """(*key, fit): the mean information between ``better`` and the buckets of ``company`` (*key, better, bucket, n).

    A pair counts as seen ``BEFORE`` times as often as chance has it beforehand.
    Without vectors of ``better``, or without company, there is no row.
    """
    shares = grams.groupBy("bucket").agg(F.sum("n").alias("c"))
    total = shares.agg(F.sum("c").alias("all"))
    share = shares.join(F.broadcast(total)).select("bucket", (F.col("c") / F.col("all")).alias("share"))
    betters = company.select(F.col("better").alias("word")).distinct()
    own = grams.join(betters, "word", "left_semi")
    of = own.groupBy(F.col("word").alias("better")).agg(F.sum("n").alias("of"))
    seen = own.select(F.col("word").alias("better"), "bucket", F.col("n").alias("seen"))
    rows = company.join(of, "better").join(share, "bucket").join(seen, ["better", "bucket"], "left")
    pmi = F.log((F.coalesce("seen", F.lit(0)) + BEFORE * F.col("share")) / ((F.col("of") + BEFORE) * F.col("share")))
    return rows.groupBy(*key).agg((F.sum(F.col("n") * pmi) / F.sum("n")).alias("fit"))


def neighbours(links: DataFrame, grams: DataFrame) -> DataFrame:
    """The links whose frequent word is a neighbour of the rare one: its vector expects the rare word's company.

    The longer a word, the less likely it is like another by chance, and the
    less its company need say.  A word in whose lines no other word stands has no company; it is linked
    only where it holds a sign no word has.
    """
    key = ["word", "better"]
    company = links.select("word", "better").join(grams, "word")
    fit = information(company, grams, key)
    alone = links.select("word").distinct().join(grams.select("word").distinct(), "word", "left_anti").withColumn("alone", F.lit(True))
    rows = links.join(fit, key, "left").join(alone, "word", "left")
    return rows.where((F.col("fit") + LETTER * F.length("word") >= 0) | (F.col("odd") & F.col("alone"))).drop("alone").withColumnRenamed("fit", "near")


def in_context(lines: DataFrame, links: DataFrame, grams: DataFrame) -> DataFrame:
    """(workId, unitIndex, lineNo, word, better, headLength, last): each occurrence of a linked word and the word that fits best there.

    The context is ``WINDOW`` words on either side, those of the lines around
    included.  Among several candidates the fit and the logarithm of the
    frequency decide, then the word itself.
    """
    tokens = lines.where("kind = 'text'").select("workId", "unitIndex", "lineNo", "tokens", "before", "after", "headLength", "splits", F.posexplode("tokens").alias("at", "word"))
    hits = tokens.join(links, "word").withColumn("last", F.col("splits") & (F.col("at") == F.size("tokens") - 1))
    stream = F.concat("before", "tokens", "after")
    place = F.col("at") + F.size("before")
    left = F.slice(stream, F.greatest(place - WINDOW, F.lit(0)) + 1, F.least(place, F.lit(WINDOW)))
    around = F.concat(left, F.slice(stream, place + 2, F.lit(WINDOW)))
    hits = materialize(hits.withColumn("around", F.transform(around, lambda w: (F.crc32(w.cast("binary")) % BUCKETS).cast("int"))).drop("tokens", "before", "after", "splits"), "hits")
    key = ["workId", "unitIndex", "lineNo", "at", "word", "better"]
    fit = information(hits.select(*key, F.explode("around").alias("bucket"), F.lit(1).alias("n")), grams, key)
    scored = hits.join(fit, key, "left").where((F.col("fit") + LETTER * F.length("word") >= 0) | (F.col("odd") & (F.size("around") == 0)))
    best = F.min(F.struct((-(F.coalesce("fit", F.lit(0.0)) + F.log10("m"))).alias("s"), "better", "headLength", "last")).alias("b")
    return scored.groupBy("workId", "unitIndex", "lineNo", "at", "word").agg(best).select("workId", "unitIndex", "lineNo", "word", "b.better", "b.headLength", "b.last")


class Scans:
    """What was found in the units of scanned books: the steps the results are made from."""

    def __init__(self, units: DataFrame) -> None:
        authors = units.where("workId IS NOT NULL").groupBy("workId", "unitIndex").agg(F.max("author").alias("author"))
        self.units = current_units(units).join(authors, ["workId", "unitIndex"], "left")
        self.lines = materialize(scanned_lines(self.units), "lines")
        text = self.lines.where("kind = 'text'")
        counts = materialize(text.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")), "words")
        #: Skip-gram vectors of all words, as counts.
        self.grams = materialize(skip_grams(self.lines), "vectors")
        links = materialize(glyph_links(counts), "links")
        self.neighbours = materialize(neighbours(links, self.grams), "neighbours")
        #: Corrections: (workId, unitIndex, lineNo, word, better, headLength, last).
        self.fixes = materialize(in_context(self.lines, self.neighbours, self.grams), "fixes")
        ends = text.where("tail IS NOT NULL AND next IS NOT NULL").select("workId", "unitIndex", "lineNo", "tail", "next", F.concat("tail", "next").alias("word"))
        whole = ends.join(counts.where(F.col("n") >= FREQUENT), "word")
        for side in ("tail", "next"):
            whole = whole.join(counts.select(F.col("word").alias(side), F.col("n").alias(f"n_{side}")), side, "left")
        rarer = F.least(F.coalesce("n_tail", F.lit(0)), F.coalesce("n_next", F.lit(0)))
        #: Line ends inside a word without a hyphen: (workId, unitIndex, lineNo).
        self.bare_splits = materialize(whole.where(rarer * 3 <= F.col("n")).select("workId", "unitIndex", "lineNo", "tail", "next"), "splits")

    def found(self) -> DataFrame:
        """(workId, unitIndex, lineNo, kind): every trace of the printed page, by line."""
        key = ["workId", "unitIndex", "lineNo"]
        furniture = self.lines.where("kind IN ('running_header', 'page_number')").select(*key, "kind")
        cut = self.lines.where("splits").select(*key).unionByName(self.bare_splits.select(*key)).withColumn("kind", F.lit("split_word"))
        # a fragment at a line end that was cut without a hyphen is no misread word
        torn = self.bare_splits.select(*key, F.col("tail").alias("word")).unionByName(self.bare_splits.select("workId", "unitIndex", (F.col("lineNo") + 1).alias("lineNo"), F.col("next").alias("word")))
        fixes = self.fixes.join(torn.distinct(), [*key, "word"], "left_anti")
        # in a word cut over two lines the line with the first differing character counts
        same = F.expr("aggregate(sequence(1, greatest(length(word), 1)), 0, (n, i) -> if(n = i - 1 AND substring(word, i, 1) = substring(better, i, 1), i, n))")
        later = F.col("last") & (same >= F.col("headLength"))
        follows = self.lines.where("kind = 'text'").select("workId", "unitIndex", "lineNo")
        here = fixes.where(~later).select(*key)
        there = fixes.where(later).select("workId", "unitIndex", F.col("lineNo").alias("from"))
        there = there.join(follows, ["workId", "unitIndex"]).where("lineNo > from").groupBy("workId", "unitIndex", "from").agg(F.min("lineNo").alias("lineNo")).select(*key)
        lost = self.lines.where("kind = 'text'").where(F.exists("tokens", lambda w: w.rlike(r"\p{L}\x{FFFD}+\p{L}|ſ") & (F.length(w) >= 3))).select(*key)
        misread = here.unionByName(there).unionByName(lost).withColumn("kind", F.lit("misread"))
        return furniture.unionByName(cut).unionByName(misread).distinct()

    def repaired(self) -> DataFrame:
        """(workId, unitIndex, paragraphs, text, fixed, joined, removed): every unit as continuous paragraphs parted by blank lines.

        Null content gives an empty text.
        """
        fixes = self.fixes.groupBy("workId", "unitIndex").agg(F.collect_set(F.struct("word", "better")).alias("fixes"))
        joins = self.bare_splits.groupBy("workId", "unitIndex").agg(F.collect_set("lineNo").alias("joins"))
        rows = self.units.select("workId", "unitIndex", "content", "author", "title").join(fixes, ["workId", "unitIndex"], "left").join(joins, ["workId", "unitIndex"], "left")

        schema = "workId string, unitIndex bigint, paragraphs int, text string, fixed int, joined int, removed int"

        def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return in_lots(((len(c or ""), [(w, u, *reflow(c or "", a, t, {x["word"]: x["better"] for x in f or ()}, set(j or ())))]) for w, u, c, a, t, f, j in each_row(batches)), schema)

        return rows.mapInArrow(repair, schema)


def _like(model: str, word: str) -> str:
    return word.upper() if model.isupper() and len(model) > 1 else word[:1].upper() + word[1:] if model[:1].isupper() else word


def reflow(content: str, author: str | None, title: str | None, fixes: dict[str, str], joins: set[int]) -> tuple[int, str, int, int, int]:
    """(paragraphs, text, fixed words, joined words, removed lines) of one unit."""
    lines = content.split("\n")
    kinds = line_kinds(lines, author, title)
    blocks: list[str] = []
    fixed = joined = 0
    removed = sum(k in ("running_header", "page_number") for k in kinds)
    open_, broken = False, False
    glue = ""
    for i, (line, kind) in enumerate(zip(lines, kinds), 1):
        s = line.strip()
        if kind in ("running_header", "page_number", "mark"):
            broken = True
        elif kind == "blank":
            open_ = open_ and (broken or any(k in ("running_header", "page_number", "mark") for k in kinds[i : i + 4]))
        elif kind == "heading":
            blocks.append(s)
            open_, glue, broken = False, "", False
        else:
            if open_ and (glue == "" or not broken or s[:1].islower() or not re.search(r"[.!?]['\"”’»)]*$", blocks[-1])):
                blocks[-1] += glue + s
            else:
                blocks.append(s)
            open_, broken, glue = True, False, " "
            if _CUT.search(blocks[-1]):
                bare = re.sub(rf"[{HYPHENS}]\s*$", "", blocks[-1])
                if any(k == "text" for k in kinds[i:]):
                    blocks[-1], glue = bare, ""
                    joined += 1
            elif i in joins:
                glue = ""
                joined += 1

    def fix(m: re.Match) -> str:
        nonlocal fixed
        raw = m[0]
        core = raw.strip(_EDGES)
        better = fixes.get(core.lower())
        if better is None:
            return raw
        fixed += 1
        return raw.replace(core, _like(core, better), 1)

    blocks = [_TOKEN.sub(fix, b) for b in blocks] if fixes else blocks
    return len(blocks), "\n\n".join(blocks), fixed, joined, removed
