"""Texts with stable context for retrieval: labels, context lines and anchors are put in, the text stays as it is.

A unit is read once, line by line, by a function per document; the hash of the
lines that carry text must be the same before and after.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookloom.functions.text import NO_PAYLOAD

#: Characters after which a context line is repeated at the next blank line, before the first page or section.
SPACING = 4500
# How a context line begins, what stands for the part until it is known, and the label of a text without a title.
CONTEXT, PART, OPENING = "[CORPUS_CONTEXT:", "{{PART}}", "### FRONT MATTER: Source opening"
# First words of a section's title and the kind of section they make.
KINDS = {"part": "PART", "chapter": "CHAPTER", "appendix": "APPENDIX", "preface": "PREFACE", "foreword": "FOREWORD", "introduction": "INTRODUCTION", "contents": "CONTENTS", "table of contents": "CONTENTS", "bibliography": "REFERENCES", "references": "REFERENCES"}
# Kinds of section that may follow inside a list of contents.
AFTER_CONTENTS = ("CHAPTER", "PART", "INTRODUCTION")
# Words that are small in a title.
SMALL_WORDS = {"a", "an", "and", "as", "at", "for", "from", "in", "of", "on", "or", "the", "to", "versus", "with"}
#: Least and greatest length of a title, most words, least length of a line that follows one and is none itself.
SHORTEST, LONGEST, MOST_WORDS, FOLLOWS = 3, 150, 18, 35
#: Of a title in a collection: least letters, letters among signs, capitals among letters, capitalised among great words, most words.
LETTERS, LETTER_SHARE, CAPITALS, CAPITALISED, TITLE_WORDS = 10, 0.72, 0.72, 0.8, 12

_BOUNDARY = re.compile(r"^#{1,6}\s+(page|section)\s+(.+?)\s*$", re.I)
_HEADING = re.compile(r"^#{1,6}\s+(.+?)\s*$")
# Fixed values, one rule each: what a title begins with where it is numbered by parts, or named, or by decimals.
_BY_PART = re.compile(r"^(?:part|chapter)\s+(?:[ivxlcdm]+|\d+)\b", re.I)
_APPENDIX = re.compile(r"^appendix(?:\s+[A-Z\d]+)?(?:\s*[—:-]\s*.+)?$", re.I)
_NAMED = re.compile(r"^(?:preface|foreword|introduction|prologue|epilogue|contents|table of contents|bibliography|references)(?:\s*[—:-]\s*.+)?$", re.I)
_DECIMAL = re.compile(r"^\d+(?:\.\d+)+\.?\s+")
_DECIMAL_TITLE = re.compile(r"^\d+(?:\.\d+)+\.?\s+[A-ZÀ-Ž]")
# Fixed values, one rule each: lines that are no titles: marks, pages, running numerals, no letters, sentences, signs, numbers at the end.
_NO_TITLE = [re.compile(p, f) for p, f in ((r"^#{1,6}\s+", 0), (r"^\[CORPUS_CONTEXT:", 0), (r"^page\s+\d+\b", re.I), (r"^[ivxlcdm]+\s+[A-Z][A-Z\s]+$", re.I), (r"^[\d\W_]+$", 0), (r"[.!;:,]$", 0), (r"[©®™]", 0), (r"\d\s*$", 0))]
_SENTENCE = re.compile(r"[.!;]\s+(\S)")
_LETTER = re.compile(r"[A-Za-zÀ-Žà-ž]")
_CAPITALISED = re.compile(r"^[A-ZÀ-Ž][A-Za-zÀ-Žà-ž’'\-]*$")
_DROPPED = re.compile(NO_PAYLOAD)


def words_of(text: str) -> str:
    """Lower-case words of letters a to z and digits."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", text.lower()) if not unicodedata.combining(c))
    return re.sub(r"[^a-z0-9]+", " ", bare).strip()


def echoes_book(line: str, author: str | None, title: str | None) -> bool:
    """Whether a line repeats the book's title or author, as running headers do.

    It holds the title's longer words, three at most; or two of the author's
    words; or it has three words at most, of which one is the author's last.
    """
    words, own, names = words_of(line), words_of(title or ""), [w for w in words_of(author or "").split() if len(w) > 2]
    if not words or not own:
        return False
    long = [w for w in own.split() if len(w) > 3]
    if sum(w in words for w in long) >= min(3, max(1, len(long))):
        return True
    if len(names) >= 2 and sum(w in words for w in names) >= 2:
        return True
    return len(words.split()) <= 3 and bool(names) and names[-1] in words.split()


def is_title(line: str, author: str | None = None, title: str | None = None, collection: bool = False) -> bool:
    """Whether a line opens a section: by its wording or number, or, in a collection, by its capitals.

    Sentences, page numbers, running headers and very long lines do not.
    """
    s = line.strip()
    if not SHORTEST <= len(s) <= LONGEST or any(p.search(s) for p in _NO_TITLE) or (not _DECIMAL.match(s) and any(c.isupper() for c in _SENTENCE.findall(s))):
        return False
    words = [re.sub(r"^[^A-Za-zÀ-Žà-ž\d]+|[^A-Za-zÀ-Žà-ž\d]+$", "", w) for w in s.split()]
    if len(words) > MOST_WORDS or echoes_book(s, author, title):
        return False
    if _BY_PART.match(s) or _APPENDIX.match(s) or _NAMED.match(s) or _DECIMAL_TITLE.match(s):
        return True
    letters = _LETTER.findall(s)
    if not collection or s[0].isdigit() or len(letters) < LETTERS or len(letters) < LETTER_SHARE * len(re.sub(r"\s", "", s)):
        return False
    if sum(c == c.upper() for c in letters) >= CAPITALS * len(letters) and 2 <= len(words) <= TITLE_WORDS:
        return True
    great = [w for w in words if _LETTER.search(w) and w.lower() not in SMALL_WORDS]
    return 2 <= len(great) <= TITLE_WORDS and sum(bool(_CAPITALISED.match(w)) for w in great) >= CAPITALISED * len(great)


def tidy_title(title: str) -> str:
    """A section's title without the page number behind it."""
    title = re.sub(r"\s+", " ", title).strip()
    if _DECIMAL.match(title):
        title = re.sub(r"\s+\d+$", "", title)
    return re.sub(r"^(PREFACE|CONTENTS)\s+[ivxlcdm]+$", r"\1", title, flags=re.I)


def kind_of(title: str) -> str:
    """The kind of section a title opens."""
    low = title.lower()
    if re.match(r"\d+\s+", title):
        return "CHAPTER"
    return next((k for w, k in sorted(KINDS.items(), key=lambda x: -len(x[0])) if re.match(rf"{w}\b", low)), "SECTION")


def leading_title(lines: list[str], author: str | None, title: str | None, collection: bool = False) -> str:
    """The title that opens a block, or nothing: its first line, set off by a blank one, or a number alone and the line after it."""
    full = [i for i, x in enumerate(lines) if x.strip()][:2]
    if not full:
        return ""
    title_like = lambda x: is_title(x, author, title, collection)
    first = lines[full[0]].strip()
    second = lines[full[1]].strip() if len(full) > 1 else ""
    if first.isdigit() and title_like(second):
        return tidy_title(f"{first} {second}")
    beside = full[0] + 1 < len(lines) and lines[full[0] + 1].strip()
    if not title_like(first) or beside or (second and len(second) < FOLLOWS and title_like(second)):
        return ""
    return tidy_title(first)


def payload_hash(text: str) -> str:
    """SHA-256 of the lines that carry text."""
    lines = [x for x in re.split(r"\r?\n", text) if x.strip() and not _DROPPED.search(x)]
    return hashlib.sha256("\n".join(lines).encode("utf-8", "surrogatepass")).hexdigest()


def _tidy(value: str | None) -> str:
    return re.sub(r"\s+", " ", re.sub(r"[\r\n|\]]+", " ", value or "")).strip()


def with_context(text: str, book: str, author: str | None, title: str | None, collection: bool = False) -> tuple[str, list[tuple[str, str, str]]]:
    """(text with context, sections as (kind, title, anchor)).  Raises if a line of the text would be lost or changed."""
    fixed = [f"BOOK_ID={_tidy(book)}", f"AUTHOR={_tidy(author)}", f"TITLE={_tidy(title)}", f"PART={PART}"]
    section: tuple[str, str, str] | None = None
    boundary: tuple[str, str] | None = None
    known: dict[tuple[str, str], tuple[str, str, str]] = {}
    lines = text.replace("\r\n", "\n").strip("\n").split("\n")
    bounds = [i for i, x in enumerate(lines) if _BOUNDARY.match(x)] + [len(lines)]
    after = dict(zip(bounds, bounds[1:]))
    since = 0

    def context() -> str:
        more = [f"{section[0]}={_tidy(section[1])}"] if section else []
        more += [f"{boundary[0]}={_tidy(boundary[1])}"] if boundary else []
        return f"{CONTEXT} {' | '.join([*fixed, *more])}]"

    own = None if _BOUNDARY.match(lines[0]) else _HEADING.match(lines[0])
    out = [f"### SOURCE TITLE: {own[1]}" if own else OPENING, "", context(), ""]
    for i, line in enumerate(lines):
        if own and not i:
            continue
        if m := _BOUNDARY.match(line):
            boundary = (m[1].upper(), m[2])
            found = leading_title(lines[i + 1 : after[i]], author, title, collection)
            if found and not (section and (found == section[1] or section[0] == "CONTENTS" and kind_of(found) not in AFTER_CONTENTS)):
                key = (kind_of(found), words_of(found))
                if key not in known:
                    slug = lambda x: words_of(x).replace(" ", "-")[:72]
                    known[key] = (key[0], found, f"retrieval-{slug(book)}-{len(known) + 1}-{slug(found) or 'section'}")
                    out += ["", f'<a id="{known[key][2]}"></a>', "", f"### {key[0]}: {found}", ""]
                section = known[key]
            out += [f"#### {'PAGE' if boundary[0] == 'PAGE' else 'SOURCE SECTION'}: {boundary[1]}", "", context(), ""]
        elif m := _HEADING.match(line):
            out.append(f"##### SOURCE HEADING: {m[1]}")
            since += len(out[-1]) + 1
        else:
            out.append(line)
            since += len(line) + 1
            if boundary is None and not line.strip() and since >= SPACING:
                out += [context(), ""]
                since = 0
    made = re.sub(r"\n{4,}", "\n\n\n", "\n".join(out)).strip("\n")
    if payload_hash(made) != payload_hash(text):
        raise ValueError(f"the text of {book} was changed")
    return made, list(known.values())


def retrieval_units(units: DataFrame) -> DataFrame:
    """(workId, unitIndex, text, payload, sections) of units (workId, unitIndex, unitCount, author, title, content).

    The part of each context line is ``unitIndex/unitCount``.  Null content is an empty text.
    """

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for work, i, n, author, title, content in pdf.itertuples(index=False):
                made, sections = with_context(content or "", work, author, title)
                part = f"{int(i)}/{int(n)}" if n == n and n is not None else f"{int(i)}"
                out.append((work, i, made.replace(PART, part), payload_hash(made), [{"kind": k, "title": t, "anchor": a} for k, t, a in sections]))
            yield pd.DataFrame(out, columns=["workId", "unitIndex", "text", "payload", "sections"])

    rows = units.where("workId IS NOT NULL AND unitIndex IS NOT NULL").select("workId", "unitIndex", "unitCount", "author", "title", "content")
    return rows.mapInPandas(make, "workId string, unitIndex bigint, text string, payload string, sections array<struct<kind: string, title: string, anchor: string>>")


def broken_units(made: DataFrame) -> DataFrame:
    """(workId, unitIndex, problem): units that break a rule of finished texts.

    A unit has a context line; no heading of level 1 or 2 is left inside; every
    boundary has a context line within six lines.
    """
    lines = F.split("text", "\n")
    at = lambda pattern: F.filter(F.transform(lines, lambda x, i: F.when(x.rlike(pattern), i)), lambda i: i.isNotNull())
    rows = made.select("workId", "unitIndex", at(r"^\[CORPUS_CONTEXT:").alias("contexts"), at(r"^#{1,2}\s").alias("high"), at(r"^#### (?:PAGE|SOURCE SECTION): ").alias("marks"))
    far = F.exists("marks", lambda m: ~F.exists("contexts", lambda c: (c > m) & (c <= m + 6)))
    problems = F.array_compact(F.array(F.when(F.size("contexts") == 0, "missing_context"), F.when(F.size("high") > 0, "nested_heading"), F.when(far, "boundary_without_context")))
    return rows.select("workId", "unitIndex", F.explode(problems).alias("problem"))
