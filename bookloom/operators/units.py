"""Cutting books into units that fit a part of a file, and merged files: their bodies, index, links and checks."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, MapType, StringType

#: A cut is moved back to a line end or space in this last part of the longest prefix that fits.
LAST_PART = 0.25
# What parts paragraphs, links from an index into a file, and the anchor and heading of a section.
PARAGRAPHS, LINK, SECTION = r"\n{2,}", r"\]\(\./([^#)]+\.md)#([^)]+)\)", r"<a id=\"(retrieval-[^\"]+)\"></a>\n(?:[^\n]*\n){0,2}?###\s+([A-Z ]+):\s+([^\n]+)"


def quarter_bytes(text: str) -> int:
    """A token for every four bytes, where no tokenizer is given."""
    return -(-len(text.encode("utf-8", "surrogatepass")) // 4)


def token_counts(text: Column, counters: dict[str, Callable[[str], int]]) -> Column:
    """The tokens of a text by each named tokenizer, as a map; null has none."""

    @F.pandas_udf(MapType(StringType(), LongType()))
    def counted(column: pd.Series) -> pd.Series:
        return column.map(lambda t: {name: int(count(t or "")) for name, count in counters.items()})

    return counted(text)


def most_tokens(counts: Column) -> Column:
    """The greatest of several token counts."""
    return F.array_max(F.map_values(counts))


def longest_prefix(text: str, fits: Callable[[str], bool]) -> int:
    """The length of the longest beginning of a text that fits; what fits must still fit when shortened."""
    low, high = 0, len(text)
    while low < high:
        middle = (low + high + 1) // 2
        if fits(text[:middle]):
            low = middle
        else:
            high = middle - 1
    return low


def cut_segment(text: str, fits: Callable[[str], bool]) -> list[str]:
    """A text in pieces that fit, cut at the last line end or space near the end of each, trimmed.  Raises where not even one character fits."""
    pieces = []
    while not fits(text):
        end = longest_prefix(text, fits)
        if not end:
            raise ValueError("a single character exceeds the limit")
        start = int(end * (1 - LAST_PART))
        at = max(text.rfind("\n", start, end), text.rfind(" ", start, end))
        end = at if at > start else end
        pieces.append(text[:end].strip())
        text = text[end:].strip()
    return [*pieces, text] if text else pieces


def split_book(text: str, byte_limit: int, token_limit: int, count: Callable[[str], int] = quarter_bytes) -> list[str]:
    """A book in units within both limits: whole if it fits, else as many paragraphs together as fit by the sums of their sizes."""
    size = lambda t: len(t.encode("utf-8", "surrogatepass"))
    fits = lambda t: size(t) <= byte_limit and count(t) <= token_limit
    if fits(text):
        return [text]
    joint = "\n\n"
    parts = [p for paragraph in re.split(PARAGRAPHS, text) for p in cut_segment(paragraph, fits) or [""]]
    units, held, held_bytes, held_tokens = [], [], 0, 0
    for part in [*parts, None]:
        more = (size(part) + size(joint) * bool(held), count(part) + count(joint) * bool(held)) if part is not None else (byte_limit + 1, 0)
        if held and (held_bytes + more[0] > byte_limit or held_tokens + more[1] > token_limit):
            units += cut_segment(joint.join(held), fits)
            held, held_bytes, held_tokens = [], 0, 0
            more = (size(part), count(part)) if part is not None else more
        if part is not None:
            held.append(part)
            held_bytes, held_tokens = held_bytes + more[0], held_tokens + more[1]
    return units


def book_units(books: DataFrame, byte_limit: int, token_limit: int, count: Callable[[str], int] = quarter_bytes) -> DataFrame:
    """(workId, unitIndex, unitCount, content, bytes, tokens) of books (workId, content); null content is one empty unit."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for work, content in zip(pdf["workId"], pdf["content"]):
                units = split_book(content or "", byte_limit, token_limit, count) or [""]
                out += [(work, k, len(units), u, len(u.encode("utf-8", "surrogatepass")), count(u)) for k, u in enumerate(units, 1)]
            yield pd.DataFrame(out, columns=["workId", "unitIndex", "unitCount", "content", "bytes", "tokens"])

    return books.select("workId", "content").mapInPandas(split, "workId string, unitIndex long, unitCount long, content string, bytes long, tokens long")


def _heading(author: Column, title: Column) -> Column:
    return F.concat(F.when(F.coalesce(author, F.lit("")) != "", F.concat(author, F.lit(" — "))).otherwise(""), F.coalesce(title, F.lit("")))


def sections_of(content: Column) -> Column:
    """array<struct<type, title, anchor>> of the sections that context was put before."""
    found = F.regexp_extract_all(content, F.lit(SECTION), F.lit(0))
    return F.transform(found, lambda x: F.struct(F.regexp_extract(x, SECTION, 2).alias("type"), F.trim(F.regexp_extract(x, SECTION, 3)).alias("title"), F.regexp_extract(x, SECTION, 1).alias("anchor")))


def merged_bodies(units: DataFrame) -> DataFrame:
    """(corpus, file, name, text): one merged file for each packed file.

    ``units``: corpus, file, name, workId, author, title, unitIndex, unitCount,
    anchor, content.  Units come by author, title and part: first the contents,
    then each unit with its anchor, heading, data, context line and sections.  A
    file's size is bounded by what was packed into it.
    """
    part = F.concat(F.col("unitIndex").cast("string"), F.lit("/"), F.col("unitCount").cast("string"))
    shown = F.concat(_heading(F.col("author"), F.col("title")), F.when(F.col("unitCount") > 1, F.concat(F.lit(" ("), part, F.lit(")"))).otherwise(""))
    inside = F.transform(sections_of(F.col("content")), lambda s: F.concat(F.lit("- ["), s["type"], F.lit(": "), s["title"], F.lit("](#"), s["anchor"], F.lit(")")))
    lines = [F.concat(F.lit('<a id="'), "anchor", F.lit('"></a>')), F.lit(""), F.concat(F.lit("## BOOK: "), shown), F.lit(""), F.lit("<!-- CORPUS_METADATA_BEGIN -->"), F.concat(F.lit("BOOK_ID: "), "anchor"), F.concat(F.lit("WORK_ID: "), "workId"), F.concat(F.lit("AUTHOR: "), F.coalesce("author", F.lit(""))), F.concat(F.lit("TITLE: "), F.coalesce("title", F.lit(""))), F.concat(F.lit("BOOK_PART: "), part), F.lit("<!-- CORPUS_METADATA_END -->"), F.lit("")]
    context = F.concat(F.lit("[CORPUS_CONTEXT: BOOK_ID="), "anchor", F.lit(" | AUTHOR="), F.coalesce("author", F.lit("")), F.lit(" | TITLE="), F.coalesce("title", F.lit("")), F.lit(" | PART="), part, F.lit("]"))
    body = F.concat_ws("\n", *lines, context, F.lit(""), F.lit("### BOOK CONTENTS"), F.lit(""), F.array_join(inside, "\n"), F.lit(""), F.coalesce("content", F.lit("")))
    entry = F.concat(F.lit("- ["), shown, F.lit("](#"), F.col("anchor"), F.lit(")"))
    rows = units.select("corpus", "file", "name", F.struct(F.coalesce("author", F.lit("")).alias("a"), F.coalesce("title", F.lit("")).alias("t"), "unitIndex", "workId", entry.alias("entry"), body.alias("body")).alias("u"))
    files = rows.groupBy("corpus", "file", "name").agg(F.array_sort(F.collect_list("u")).alias("u"))
    text = F.concat_ws("\n", F.concat(F.lit("# CORPUS FILE: "), "name"), F.lit(""), F.lit("## FILE CONTENTS"), F.lit(""), F.array_join(F.transform("u", lambda u: u["entry"]), "\n"), F.lit(""), F.array_join(F.transform("u", lambda u: u["body"]), "\n\n"), F.lit(""))
    return files.select("corpus", "file", "name", text.alias("text"))


def corpus_index(units: DataFrame) -> DataFrame:
    """(corpus, text): the index of each corpus, with links to all parts of every work in its files."""
    link = F.struct("name", "unitIndex", F.concat(F.lit("](./"), "name", F.lit("#"), "anchor", F.lit(")")).alias("to"))
    works = units.groupBy("corpus", "workId").agg(F.max("author").alias("author"), F.max("title").alias("title"), F.array_sort(F.collect_list(link)).alias("links"))
    numbered = F.transform("links", lambda x, i: F.concat(F.lit("["), (i + 1).cast("string"), x["to"]))
    entry = F.concat(F.lit("## "), _heading(F.col("author"), F.col("title")), F.lit("\n\n"), F.array_join(numbered, ", "))
    rows = works.groupBy("corpus").agg(F.count(F.lit(1)).alias("works"), F.array_sort(F.collect_list(F.struct(F.coalesce("author", F.lit("")).alias("a"), F.coalesce("title", F.lit("")).alias("t"), "workId", entry.alias("entry")))).alias("w"))
    return rows.select("corpus", F.concat(F.lit("# "), "corpus", F.lit("\n\n"), F.col("works").cast("string"), F.lit("\n\n"), F.array_join(F.transform("w", lambda w: w["entry"]), "\n\n"), F.lit("\n")).alias("text"))


def locations(units: DataFrame) -> DataFrame:
    """(workId, places): the file and anchor of every part of a work, in order."""
    return units.groupBy("workId").agg(F.transform(F.array_sort(F.collect_list(F.struct("unitIndex", "name", "anchor"))), lambda x: F.concat(x["name"], F.lit("#"), x["anchor"])).alias("places"))


def index_targets(index: DataFrame) -> DataFrame:
    """(corpus, target): what the links of an index (corpus, text) point to, as often as they do."""
    found = F.explode(F.regexp_extract_all("text", F.lit(LINK), F.lit(0)))
    return index.select("corpus", found.alias("l")).select("corpus", F.concat(F.regexp_extract("l", LINK, 1), F.lit("#"), F.regexp_extract("l", LINK, 2)).alias("target"))


def target_differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(corpus, target, expected, actual): targets that are not linked exactly as often as they should be."""
    counted = lambda d, name: d.groupBy("corpus", "target").agg(F.count(F.lit(1)).alias(name))
    both = counted(expected, "expected").join(counted(actual, "actual"), ["corpus", "target"], "full_outer").na.fill(0, ["expected", "actual"])
    return both.where("expected != actual")


def write_merged(bodies: DataFrame, folder: str, byte_limit: int) -> None:
    """Write merged files as ``corpus=…/name=…`` text; a file above the limit is an error."""
    size = F.octet_length("text")
    checked = F.when(size > byte_limit, F.raise_error(F.concat(F.col("name"), F.lit(" has "), size.cast("string"), F.lit(" bytes")))).otherwise(F.col("text"))
    bodies.select("corpus", "name", checked.alias("value")).repartition("corpus", "name").write.mode("overwrite").partitionBy("corpus", "name").text(folder)


def merged_problems(bodies: DataFrame) -> DataFrame:
    """(corpus, name, line, problem): where merged files (corpus, name, text) break a rule; lines count from 1, 0 is the whole file.

    Id, author and title stand within 19 lines of a book's heading; inside a book,
    that is up to the next heading of level 1, no heading is of level 1 or 2 but
    another book's; a page or section has a context line within six lines; a file
    has a book and a context line at least.
    """
    lines = bodies.select("corpus", "name", F.split("text", r"\r?\n").alias("x"))
    at = lambda pattern: F.filter(F.transform("x", lambda v, i: F.when(v.rlike(pattern), i + 1)), lambda i: i.isNotNull())
    marks = lines.select("corpus", "name", at(r"^## BOOK: ").alias("books"), at(r"^#\s").alias("tops"), at(r"^##?\s").alias("heads"), at(r"^\[CORPUS_CONTEXT:").alias("contexts"), at(r"^#### (?:PAGE|SOURCE SECTION): ").alias("bounds"), at(r"^BOOK_ID: \S").alias("ids"), at(r"^AUTHOR: ").alias("authors"), at(r"^TITLE: ").alias("titles"))
    near = lambda i, places, most: F.exists(places, lambda k: (k > i) & (k <= i + most))
    bare = F.filter("books", lambda i: ~(near(i, "ids", 19) & near(i, "authors", 19) & near(i, "titles", 19)))
    # the last book or top heading before a heading tells whether that stands inside a book
    last = lambda places, i: F.coalesce(F.array_max(F.filter(places, lambda k: k < i)), F.lit(0))
    nested = F.filter("heads", lambda i: ~F.array_contains("books", i) & ~F.array_contains("tops", i) & (last("books", i) > last("tops", i)))
    far = F.filter("bounds", lambda i: ~near(i, "contexts", 6))

    def told(places: Column, what: str) -> Column:
        return F.transform(places, lambda i: F.struct(i.alias("line"), F.lit(what).alias("problem")))

    found = [told(bare, "book_without_data"), told(nested, "nested_heading"), told(far, "boundary_without_context")]
    whole = F.array_compact(F.array(*[F.when(F.size(c) == 0, F.struct(F.lit(0).alias("line"), F.lit(what).alias("problem"))) for c, what in (("books", "no_book"), ("contexts", "no_context"))]))
    return marks.select("corpus", "name", F.inline(F.concat(*found, whole)))
